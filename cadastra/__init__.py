"""cadastra: a Spark-first engine for versioned administrative hierarchies."""
