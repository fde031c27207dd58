"""inkstrata: analytics and quality control for converted documents on Spark."""
