"""Purchase-intent analytics over clickstreams, expressed as Spark DataFrame jobs."""
