"""Dimensional ETL and data quality on Spark."""
