"""Operators of a training-data pipeline, one module each; ``queries.py`` registers them.

Nothing outside this subpackage imports it (``__spark_entry__.py`` adds its queries when it can be
imported).  Operators take DataFrames and column names, keep only the columns they need, and
return DataFrames; written intermediate tables live under the session's ``spark.checkpoint.dir``.
"""
