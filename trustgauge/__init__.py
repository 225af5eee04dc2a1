"""Calibration and uncertainty analytics for binary text classifiers, on Spark DataFrames."""
