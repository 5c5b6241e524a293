"""Operators: DataFrame(s) -> DataFrame functions for sessions, categories, funnel, areas, ads, sampling."""
