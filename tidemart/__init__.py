"""tidemart: a Spark-first lakehouse for retail order data."""
