"""Change-data-capture to star-schema warehouse, as Spark DataFrame operators."""
