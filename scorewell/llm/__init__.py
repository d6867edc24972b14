"""Operators of a large-scale training-data pipeline (see README).

Nothing outside this package imports it; ``__spark_entry__.py`` adds its
queries when it is present.
"""
