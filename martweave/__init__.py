"""Business analytics marts, stream scoring and ledgers as plain PySpark DataFrame code."""
