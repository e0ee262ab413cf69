"""tessera: a Spark-first engine for auditing, versioning and ranking annotated datasets."""
