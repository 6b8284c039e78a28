"""inkwell: document search analytics on PySpark.

Subpackages: ``functions`` (column expressions), ``sources`` (inputs and
stores), ``operators`` (index, search, statistics, similar words, fuzzy
matching, spelling, live indexing, change detection), ``plans`` (join,
ranking and as-of helpers, the query registry, oracle SQL) and
``streaming`` (live indexer, suggestion stream, metrics).
"""

__version__ = "0.1.0"
