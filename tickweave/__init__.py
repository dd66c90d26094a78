"""Order-book and funding-rate analytics as Spark jobs."""
