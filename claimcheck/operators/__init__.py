"""Stages: DataFrame in, DataFrame out, no Python code on rows."""
