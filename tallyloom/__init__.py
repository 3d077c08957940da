"""Commerce data jobs on Spark: retail quality, ETL, marketplace metrics, review texts, order streams."""
