"""Queries that exercise the operators, with DuckDB SQL that gives the same rows."""
