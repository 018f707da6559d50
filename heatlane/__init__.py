"""Race-shaped analytics on Apache Spark.

Every operator is a function from DataFrame to DataFrame with column names as
parameters; use them with ``df.transform(...)`` or call them directly.
"""
