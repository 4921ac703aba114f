"""Crawl-corpus indexing and search as Spark DataFrame jobs."""
