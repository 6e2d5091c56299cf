"""courtside: game-statistics warehousing and analytics as plain Spark DataFrames."""
