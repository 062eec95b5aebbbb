"""Chronoloom: a PySpark engine that weaves news text into an event knowledge graph."""
