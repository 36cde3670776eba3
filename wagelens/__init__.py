"""Job-postings analytics as Spark DataFrame jobs."""
