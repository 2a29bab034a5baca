"""Documents and metadata stored by id, for look-ups that come again.

Both tables are bucketed by ``id`` with the same number of buckets, one file
each, and sorted by ``id`` inside.  So a join of the two, or of either with few
ranked rows, moves no text; a look-up of given ids opens their buckets only and
skips row groups by the least and largest id.  Building the store shuffles the
texts once; a single look-up over tables that are not stored is cheaper by
``report.lookup_ranked``.

Rows with a null id stay in the tables and match nothing; repeated ids match as
in a join; empty tables give empty results.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators import report
from quarry.session import save_bucketed, two_levels


@dataclass
class RecordStore:
    documents: DataFrame
    metadata: DataFrame

    @classmethod
    def build(cls, documents: DataFrame, metadata: DataFrame, buckets: int) -> RecordStore:
        """Stores both tables in ``buckets`` buckets, or as many as Spark allows."""
        files, _ = two_levels(documents.sparkSession, buckets)
        return cls(*(save_bucketed(df.repartition(files, "id"), name, "id", files, sort_by="id")
                     for df, name in ((documents, "record_documents"), (metadata, "record_metadata"))))

    def lookup(self) -> DataFrame:
        """Every document with its metadata (``report.document_lookup``)."""
        return report.document_lookup(self.documents, self.metadata)

    def get(self, ids: list) -> DataFrame:
        """The same for given ids (a short list of the caller)."""
        wanted = F.col("id").isin(list(ids))
        return report.document_lookup(self.documents.filter(wanted), self.metadata.filter(wanted))

    def cards(self, ranked: DataFrame) -> DataFrame:
        """Result cards of ranked rows (``report.result_cards``)."""
        return report.result_cards(ranked, documents=self.documents, metadata=self.metadata)
