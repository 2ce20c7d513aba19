"""Network-reliability analytics expressed as PySpark DataFrame jobs."""
