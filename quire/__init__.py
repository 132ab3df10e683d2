"""A PySpark engine for the quality of parsed document corpora."""
