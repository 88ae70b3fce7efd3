"""Dataset curation on Spark: catalogs, quality, annotation checks, active learning."""

__version__ = "0.1.0"
