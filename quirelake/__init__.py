"""Quirelake: a PySpark-native engine for document collections.

Documents become typed segments, segments become token-bounded chunks, and
chunks, tables and model outputs become a graph that can be queried, all as
DataFrame plans.
"""

__version__ = "0.1.0"
