"""tessera: a Spark-first engine for record linkage over DataFrames."""

__version__ = "0.1.0"
