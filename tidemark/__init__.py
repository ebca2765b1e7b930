"""tidemark: incremental revenue lakehouse on Spark.

Daily trip files land in a folder; a Structured Streaming job picks each one up
exactly once by name, writes a typed silver table keyed by (pickup date, source
file), rebuilds gold aggregates only for the dates a batch touches and refreshes
a 24-row serving table. Every write overwrites well-defined partitions, so
retries, replays and late files converge to the result of one batch over all
files.
"""

__version__ = "0.1.0"
