"""Operators for large-scale training-data pipelines.

Nothing outside this folder imports it; ``queries.py`` registers one query per operator.
"""
