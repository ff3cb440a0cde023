"""terrabrook: a Spark-first engine for place (business-listing) data and its operational queries."""
