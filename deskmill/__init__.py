"""Service-ticket warehouse, release and data-quality jobs on Apache Spark."""
