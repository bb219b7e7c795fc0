"""A Spark-first engine for versioned legal-document analytics."""
