"""quarry: a Spark-native library for lexical code search and its evaluation.

Every operator takes and returns DataFrames built from Spark SQL expressions,
joins, aggregations and windows.  The layout:

* ``quarry.functions`` - Column -> Column building blocks (text cleaning,
  tokenizer, vector math, ranking metrics, exact rounding).
* ``quarry.sources``   - readers and writers (JSONL with line numbers, the
  driver parquet tables, index and result sinks).
* ``quarry.operators`` - corpus build, inverted index, BM25 search, rerank,
  evaluation, data quality and report operators.
* ``quarry.plans``     - the registered query catalog and its SQL oracle.
* ``quarry.streaming`` - serving the BM25 search over a stream of queries.
"""

__version__ = "0.1.0"
