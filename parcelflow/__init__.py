"""Event-history forecasting on keyed, dated events, built on Spark DataFrames."""
