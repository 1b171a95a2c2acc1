"""Leafline: form-crawl extraction and table processing as Spark DataFrame jobs."""
