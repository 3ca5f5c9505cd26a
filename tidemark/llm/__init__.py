"""Training-data pipeline operators (one module per operator).

Nothing outside this folder imports it; ``queries.py`` registers one query
per operator and ``sql.py`` holds the DuckDB statements.
"""
