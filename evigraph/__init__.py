"""evigraph: evidence-graph ETL and analytics on Spark DataFrames."""
