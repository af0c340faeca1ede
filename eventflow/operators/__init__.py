"""Batch operators (DataFrame -> DataFrame)."""
