"""linkforge: Spark-native entity resolution over registration snapshots.

Stages: ingest (sources, tables) -> link (blocking, comparisons, model,
scoring) -> cluster (graph) -> explore. Every operator takes DataFrames and
plain parameters and returns a lazy DataFrame."""

__version__ = "0.1.0"
