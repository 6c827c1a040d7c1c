"""DataFrame -> DataFrame operators. All are lazy; none collects rows or uses a Python UDF."""
