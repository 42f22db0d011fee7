"""Training-data pipeline operators.

Nothing outside this folder imports it. Each module holds one operator with its own general interface; `queries.py`
holds the thin contract queries that `__spark_entry__.py` registers.
"""
