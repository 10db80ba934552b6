import random
import re

from pyspark.sql import functions as F

from evigraph.llm import common
from evigraph.llm import url_filter as uf


def brute(url, rules, default="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p) and host]
    best = max(fits, default=(0, 0, None, default))
    return host, path, best[2], best[3]


def test_against_brute_force(spark, monkeypatch):
    rng = random.Random(0)
    hosts = ["com", "a.com", "b.a.com", "net", "x.net", "example.com", "www.example.com", "exa-mple.com", "É.com"]
    rules = [(rng.choice(hosts), rng.choice(["", "/", "/en/", "/en/x", "/e"]), rng.choice(["allow", "block"])) for _ in range(12)]
    rules = list({(h, p): (h, p, v) for h, p, v in rules}.values())
    urls = [f"{rng.choice(['http', 'HTTPS'])}://{rng.choice(['', 'w.', 'W.'])}{rng.choice(hosts).upper()}{rng.choice(['', '/', '/en/', '/en/x1', '/E/', '?q=/en/', '#/en/', '/en/?a#b'])}" for _ in range(300)]
    urls += [None, "", "no scheme", "://", "a://b://c/en/", "http://\n/x"]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id int, url string")
    table = spark.createDataFrame(rules, "host string, path string, verdict string")
    want = [(i, *brute(u, rules)) for i, u in enumerate(urls)]
    for most, blocks, few in ((200_000, 1 << 18, 300_000), (0, 1, 0)):  # and with shuffled joins and a full filter
        monkeypatch.setattr(uf, "BROADCAST_RULES", most)
        monkeypatch.setattr(uf, "MOST_BLOCKS", blocks)
        monkeypatch.setattr(common, "BROADCAST_ROWS", few)
        got = sorted((r.page_id, r._host, r._path, r._rule, r._verdict) for r in uf.judge(pages, table).collect())
        assert got == want


def test_edges(spark):
    pages = spark.createDataFrame([(1, "http://a.com/", "x"), (1, "http://a.com/", "x"), (2, None, None)], "page_id int, url string, host string")
    rules = spark.createDataFrame([("a.com", "/", "block"), ("A.com", "/", "allow"), (None, None, "block")], "host string, path string, verdict string")
    assert sorted((r.page_id, r._verdict) for r in uf.judge(pages, rules).collect()) == [(1, "allow"), (1, "allow"), (2, "allow")]
    assert uf.judge(pages, rules.limit(0)).filter("_rule IS NOT NULL").count() == 0 and uf.judge(pages.limit(0), rules).count() == 0


def test_the_filter_is_one_literal_and_drops_strangers(spark):
    rules = spark.createDataFrame([(f"h{i}.com", "/", "block") for i in range(3000)], "host string, path string, verdict string")
    pages = spark.range(5000).select("id", F.concat(F.lit("http://x"), "id", F.lit(".org/a")).alias("url"))
    judged = uf.judge(pages, rules)
    plan = judged._jdf.queryExecution().optimizedPlan().toString()
    assert "from_json" not in plan and judged.filter("_rule IS NULL AND _verdict = 'allow'").count() == 5000
    found = uf.judge(pages.withColumn("url", F.concat(F.lit("https://A.H"), "id", F.lit(".com/z"))), rules)
    assert found.filter("_verdict = 'block'").count() == 3000


def test_no_python_in_the_plan(spark):
    pages = spark.createDataFrame([(1, "http://a.com/")], "page_id int, url string")
    rules = spark.sql("SELECT 'a.com' AS host, '/' AS path, 'block' AS verdict")
    plan = uf.judge(pages, rules)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
