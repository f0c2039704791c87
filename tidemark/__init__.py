"""tidemark: Bronze -> Silver -> Gold analytics over trending-content data on Spark.

Everything is expressed with the DataFrame API; see README.md for the layout.
"""

__version__ = "0.1.0"
