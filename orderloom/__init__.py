"""Order analytics on Spark: cleaning, star-schema marts, incremental loads, history and checks.

Every function takes and returns DataFrames (or Columns); nothing runs until an action, and only
``sources.tables``, ``operators.history`` and ``streaming`` touch storage.
"""
