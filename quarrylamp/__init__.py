"""Quarrylamp: a Spark-native engine for analysing large mixed-language document collections.

Every operator takes DataFrames and returns DataFrames; nothing is collected to the driver unless its size is
bounded by a parameter that the docstring names.
"""

__version__ = "0.1.0"
