"""Multi-source customer lakehouse operators on the Spark DataFrame API."""
