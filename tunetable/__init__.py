"""Post-training data preparation and analytics on Spark DataFrames."""
