"""PySpark engine that measures, groups and filters clips and their metadata for training sets."""

__version__ = "0.1.0"
