"""Training-data operators. Nothing outside this subpackage imports it.

Each module is one operator with a general interface; ``queries.py`` binds the
operators to the driver's tables.
"""
