"""tokenmix: exact corpus-mixture accounting on Spark."""

__version__ = "0.1.0"
