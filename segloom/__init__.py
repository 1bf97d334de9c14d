"""segloom: transcript and training-data processing on Apache Spark.

The core package holds the operators for segmented transcripts (boundaries,
two-level chunking, vector search, storage, ledgers, interval arithmetic).
The optional subpackage ``llm`` adds operators for training-data pipelines;
nothing in the core imports it.
"""

__version__ = "0.1.0"
