"""Token totals by source, language and tokenizer version, kept up to date by signed changes."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.llm.batches import BatchFolder
from lakeops.llm.common import map_slices, texts
from lakeops.llm.tokens import load

KEYS = ["source", "lang", "tokenizer"]


def counted(docs: DataFrame, path: str, tokenizer: str, id_col="doc_id", text_col="text") -> DataFrame:
    """doc_id, source, lang, tokenizer, n_tokens of every row; NULL and empty texts have none.

    Texts of any length are counted whole.
    """

    def make():
        coder = load(path)
        width = int(coder.dtype[-1])

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            counts = [len(x) // width for x in coder.encode(texts(batch, "text"))]
            return pa.record_batch(
                [batch.column(c) for c in ("doc_id", "source", "lang")] + [pa.array(counts, pa.int64())],
                ["doc_id", "source", "lang", "n_tokens"],
            )

        return work

    chosen = docs.select(
        docs[id_col].cast("long").alias("doc_id"),
        docs["source"].cast("string").alias("source"),
        docs["lang"].cast("string").alias("lang"),
        docs[text_col].alias("text"),
    )
    found = map_slices(chosen, "text", make, "doc_id bigint, source string, lang string, n_tokens bigint")
    return found.select("doc_id", "source", "lang", F.lit(tokenizer).alias("tokenizer"), "n_tokens")


def inserts(counts: DataFrame) -> DataFrame:
    return counts.select(*KEYS, F.lit(1).cast("long").alias("docs"), F.col("n_tokens").alias("tokens"))


def deletes(counts: DataFrame) -> DataFrame:
    return counts.select(*KEYS, F.lit(-1).cast("long").alias("docs"), (-F.col("n_tokens")).alias("tokens"))


def revisions(old: DataFrame, new: DataFrame) -> DataFrame:
    """The old counts leave, the new ones come; key and count may both change."""
    return deletes(old).unionByName(inserts(new))


class TokenTotals:
    """Additive totals in a folder of batches of summed changes.

    A batch counts as a whole or not at all, and once however often it is sent: sending it
    again replaces it, and readers see the earlier one until then (see ``BatchFolder``).
    Totals are the sum over batches, none before the first. NULL sources and languages are
    keys of their own; a NULL count adds no tokens; a batch without changes is an empty one.
    """

    def __init__(self, spark: SparkSession, path: str):
        kind = "source string, lang string, tokenizer string, docs bigint, tokens bigint"
        self.batches = BatchFolder(spark, path, kind)

    @staticmethod
    def _summed(changes: DataFrame) -> DataFrame:
        return (
            changes.groupBy(*KEYS)
            .agg(F.sum("docs").alias("docs"), F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens"))
            .filter("docs <> 0 or tokens <> 0")
        )

    def commit(self, batch: str, changes: DataFrame) -> None:
        """Add the signed ``changes`` (source, lang, tokenizer, docs, tokens) as one batch."""
        self.batches.write(batch, self._summed(changes))

    def compact(self) -> None:
        """Add up all batches into one. Their names stay known: sent again, they change nothing."""
        self.batches.fold(self._summed)

    def totals(self) -> DataFrame:
        """source, lang, tokenizer, n_docs, n_tokens of all batches; keys without rest are left out."""
        return self._summed(self.batches.read()).select(
            *KEYS, F.col("docs").alias("n_docs"), F.col("tokens").alias("n_tokens")
        )
