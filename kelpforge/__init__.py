"""kelpforge: a Spark-first engine for building, auditing and measuring training data."""
