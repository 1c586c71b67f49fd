"""pagemill: a PySpark-native engine for page-annotation datasets.

Everything is expressed as DataFrame plans; see README.md for the module map.
"""

__version__ = "0.1.0"
