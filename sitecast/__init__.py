"""Demand analytics and site selection as plain PySpark DataFrame functions."""
