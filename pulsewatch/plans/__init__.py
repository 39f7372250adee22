"""Adapters from the test tables, composed pipelines, and the query catalog."""
