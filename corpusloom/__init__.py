"""corpusloom: corpus preparation for language-model training on PySpark."""

__version__ = "0.1.0"
