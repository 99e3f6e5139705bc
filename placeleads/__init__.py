"""Place-lead analytics over captured web pages, as Spark DataFrame jobs."""
