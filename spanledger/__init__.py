"""Range-tracked ingestion and integrity operators for PySpark DataFrames."""
