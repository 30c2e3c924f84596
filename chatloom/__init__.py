"""Conversation-history jobs on Spark: DataFrame to DataFrame functions."""
