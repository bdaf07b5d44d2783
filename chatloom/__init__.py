"""Conversational-corpus analytics on Spark."""
