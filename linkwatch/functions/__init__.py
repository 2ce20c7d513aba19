"""Column helpers; every function here returns a Spark expression."""
