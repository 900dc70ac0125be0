"""Cleaning and auditing of messy tables of any size, on Spark."""
