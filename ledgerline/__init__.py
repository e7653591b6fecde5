"""Subscription analytics as ordinary Spark DataFrame functions."""
