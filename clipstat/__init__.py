"""clipstat: a Spark-native engine for snapshot-style video-channel statistics.

Landed API pages and JSON snapshot envelopes are flattened into typed rows, the newest
record per video is kept, duration / content-class / engagement columns are derived,
the result is upserted into a core table, a once-per-day history is appended, and a
declarative set of data-quality checks gates the run.  Every operator is
``DataFrame -> DataFrame`` built from Spark column expressions, joins, windows and
aggregates.
"""

__version__ = "0.1.0"
