"""Company-filing analytics as plain ``DataFrame -> DataFrame`` Spark functions."""
