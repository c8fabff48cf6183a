"""DataFrame operators of the layered jobs (each one a lazy Spark plan)."""
