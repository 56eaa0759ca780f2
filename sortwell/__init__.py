"""Dataset curation as Spark DataFrame operators."""
