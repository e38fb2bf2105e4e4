"""Scalar functions as Spark columns; all stay inside generated code."""
