"""A PySpark engine for procurement records: ingestion, matching, profiles, ranking and quality."""
