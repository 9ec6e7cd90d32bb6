"""Training-data operators: ten large-scale text and vector operators on Spark."""
