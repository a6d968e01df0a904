"""Scalar value functions as Spark columns."""
