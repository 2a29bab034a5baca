"""Structured Streaming: BM25 (and rerank) search over a stream of queries."""
