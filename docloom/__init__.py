"""Ensemble document extraction and its quality analytics, as Spark DataFrame plans."""
