"""Training, scoring and evaluation on Spark ML."""
