"""Print the physical plans of the main operators (markdown) over a stored
index at one scale factor.  usage: python scripts/show_plans.py [sf_dir]"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from quarry.operators import rerank, report, search  # noqa: E402
from quarry.plans.pipeline import DensePipeline  # noqa: E402
from quarry.session import local_session  # noqa: E402
from quarry.sources import tables  # noqa: E402


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8, 8)
    p = DensePipeline(spark, sf_dir)
    idx = p.index
    shown = {
        "Index build: postings from the processed documents (one exchange by bucket)":
            __import__("quarry.operators.index", fromlist=["build_index"])
            .build_index(p.documents).postings,
        "Vocabulary from the stored postings (partial aggregation by term)":
            __import__("quarry.operators.index", fromlist=["vocabulary_from"])
            .vocabulary_from(idx.lists, idx.statistics),
        "BM25 query phase over the bucketed postings": search.bm25_topk(idx, p.queries, 50),
        "Rerank of the BM25 candidates (stored vectors)":
            rerank.rerank(p.bm25_ranking, p.query_vectors, p.vectors, 50),
        "Hashed document vectors (inside the doc_id buckets)": rerank.hashed_document_vectors(idx),
        "Result cards (late materialisation)":
            report.result_cards(p.bm25_ranking.filter(F.col("rank") <= 10).drop("score_fp"),
                                documents=p.documents, metadata=p.metadata),
        "Ad-hoc search (benchmark texts)": search.search(idx, tables.benchmark_queries(spark, sf_dir)),
    }
    print(f"# Physical plans ({os.path.basename(sf_dir)}, local[8], 8 shuffle partitions)\n")
    print("Generated by `python scripts/show_plans.py`. Exchanges are the shuffles.\n")
    for title, df in shown.items():
        text = plan(df)
        n_ex = text.count("Exchange hashpartitioning") + text.count("Exchange SinglePartition")
        print(f"## {title}\n\nshuffle exchanges: {n_ex}\n\n```\n{text}\n```\n")
    spark.stop()


if __name__ == "__main__":
    main()
