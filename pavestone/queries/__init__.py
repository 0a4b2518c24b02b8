"""Queries over the driver's tables, with DuckDB SQL of the same rows."""
