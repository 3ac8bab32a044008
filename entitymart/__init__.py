"""Entity-dump ETL and catalog queries on Spark DataFrames."""
