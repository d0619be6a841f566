"""Report star: threat-report feeds to a star schema, as Spark DataFrame functions."""
