"""Column helpers. Everything here returns built-in Spark expressions; there is no Python UDF."""
