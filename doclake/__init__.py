"""Document corpora as tables: list, load, batch, parse, flatten and analyse them with Spark DataFrames."""

__version__ = "0.1.0"
