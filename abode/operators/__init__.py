"""DataFrame operators (DataFrame[s] + column names -> DataFrame)."""
