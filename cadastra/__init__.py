"""Company-registry analytics expressed as Spark DataFrame plans."""
