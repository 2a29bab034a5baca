"""DataFrame operators: corpus build, index, search, rerank, evaluation, quality, reports."""
