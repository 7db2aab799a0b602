"""Conversation redaction and label-quality operators for Spark DataFrames."""

__version__ = "0.1.0"
