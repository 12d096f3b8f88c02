"""Job-posting analytics expressed as Spark DataFrame transformations."""
