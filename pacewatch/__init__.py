"""Behavioural payment-risk features, profiles and scoring as PySpark DataFrames."""
