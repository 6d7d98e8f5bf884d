"""dimflow: metadata-driven dimensional pipelines and school-message facts on Spark DataFrames."""
