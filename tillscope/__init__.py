"""Merchant sales analytics on Spark."""
