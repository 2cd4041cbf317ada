"""Operators composed into the two jobs: history building and forecasting."""
