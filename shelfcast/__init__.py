"""Store and item demand forecasting expressed as Spark DataFrame jobs.

Every function takes and returns DataFrames and nothing here starts a session,
picks a master or runs an action, except the writers in ``plans``.
"""
