"""Job-posting extraction and screening as Spark DataFrame jobs."""
