"""Readers: parquet driver tables, shop stand-ins, CSV, JSON documents, JDBC."""
