"""Applicant risk features, feature selection, scoring and blending on Spark DataFrames."""
