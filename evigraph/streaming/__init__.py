"""Extensions that the reference domain lacks: evidence as a stream."""

from .evidence import evidence_counts, event_schema, outcome_windows, read_events, work_queue

__all__ = ["evidence_counts", "event_schema", "outcome_windows", "read_events", "work_queue"]
