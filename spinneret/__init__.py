"""Web-crawl analytics and inverted-index construction as Spark DataFrame jobs."""
