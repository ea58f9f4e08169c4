"""Operators of a training-data pipeline: thirteen corpus operators on Spark.

Nothing outside this package imports it; ``__spark_entry__.py`` adds its
queries when it can be imported.
"""
