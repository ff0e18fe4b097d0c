"""Composed pipelines, driver-table stand-ins and the query registry."""
