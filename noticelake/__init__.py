"""PySpark jobs for public-notice and listing data."""

__version__ = "0.1.0"
