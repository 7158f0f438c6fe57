"""Rating analytics and recommendation as plain functions over Spark DataFrames."""
