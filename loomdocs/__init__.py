"""Document-pipeline operators as Spark DataFrame transformations."""
