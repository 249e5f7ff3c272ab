"""gleanery: dataset-curation operators and analytics queries on Spark DataFrames."""
