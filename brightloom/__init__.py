"""brightloom: business-intelligence data preparation on Spark DataFrames."""
