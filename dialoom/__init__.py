"""Conversation analytics on Spark."""
