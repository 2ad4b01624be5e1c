"""Kimberlite: medallion layers and Kimball dimensional models as Spark DataFrames."""
