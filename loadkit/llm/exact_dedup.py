"""Exact deduplication against a persistent index of digests.

The index is a catalog table with a row per distinct text, bucketed and sorted by digest. A batch is
deduplicated by a sort-merge anti-join of its digests with the index, and what is new is appended.
The side of the index is neither shuffled nor read by the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loadkit.llm.common import WHITE, kept_rows, row_key, texts
from loadkit.session import materialise


def normal_text(text: Column) -> Column:
    """The text without white space; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), WHITE, "")


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, its key, the digest of its normalised text, its code points, and `turn`.

    `turn` is 1 for one row of each id and digest, the longest; it orders rows repeated under one id.
    """
    rows = texts(docs, id_col, text_col).select(
        "doc_id",
        row_key().alias("key"),
        F.unhex(F.sha2(normal_text(F.col("text")), 256)).alias("digest"),
        F.coalesce(F.char_length("text"), F.lit(0)).alias("n_points"),
    )
    same = Window.partitionBy("doc_id", "digest").orderBy(F.desc("n_points"), "key.digest")
    return rows.withColumn("turn", F.row_number().over(same))


class DigestIndex:
    """A table of the digests of all texts loaded so far.

    Choose `buckets` so that a bucket of the full index fits a task (a digest takes about 50 bytes).
    """

    def __init__(self, spark: SparkSession, table: str, buckets: int = 32, id_type: str = "bigint"):
        self.spark, self.table, self.buckets = spark, table, buckets
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {table} (digest binary, keep_id {id_type}, load_id string)"
            f" USING parquet CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS"
        )

    def append(self, found: DataFrame, load_id: str) -> None:
        """Add the digests of `found` (digest, keep_id) that the index does not have."""
        known = self.spark.table(self.table).select("digest")
        new = found.join(known.hint("merge"), "digest", "left_anti")
        (
            new.select("digest", "keep_id", F.lit(load_id).alias("load_id"))
            .repartition(self.buckets, "digest")
            .write.bucketBy(self.buckets, "digest")
            .sortBy("digest")
            .mode("append")
            .saveAsTable(self.table, format="parquet")
        )

    def deduplicate(
        self, docs: DataFrame, load_id: str, id_col: str = "doc_id", text_col: str = "text"
    ) -> DataFrame:
        """Append the new texts of a batch and say of every row whether it stays.

        Of equal texts the row with the most code points, then the smallest id, stays; a text of an
        earlier load keeps the row it has. Returns doc_id, keep_id, group_size (rows of this batch
        with the text), kept, text_sha256; a row for every row of `docs`. Null and empty texts, and
        texts of white space only, are equal to each other. A null id orders after every other. Of
        rows repeated under one id, one stays. An empty batch gives no rows and appends nothing.
        Calling again with the same `load_id` and batch gives the same answer and appends nothing.
        """
        return self.decide(docs, load_id, id_col, text_col).drop("key")

    def decide(
        self, docs: DataFrame, load_id: str, id_col: str = "doc_id", text_col: str = "text"
    ) -> DataFrame:
        """`deduplicate`, with the `key` of every row."""
        rows = materialise(digests(docs, id_col, text_col), "digests")
        # Partial aggregation: a text with a third of all rows sends one row per task.
        best = F.min(F.struct((-F.col("n_points")).alias("n"), F.col("doc_id").isNull(), "doc_id"))
        groups = materialise(
            rows.groupBy("digest")
            .agg(best.alias("best"), F.count("*").alias("group_size"))
            .select("digest", F.col("best.doc_id").alias("keep_id"), "group_size"),
            "groups",
        )
        self.append(groups.select("digest", "keep_id"), load_id)
        index = self.spark.table(self.table)
        found = groups.drop("keep_id").join(index, "digest")
        first = (F.col("load_id") == load_id) & F.col("doc_id").eqNullSafe(F.col("keep_id"))
        return rows.join(found, "digest").select(
            "doc_id",
            "keep_id",
            "group_size",
            (first & (F.col("turn") == 1)).alias("kept"),
            F.lower(F.hex("digest")).alias("text_sha256"),
            "key",
        )


def unique_rows(
    docs: DataFrame,
    index: DigestIndex,
    load_id: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    without_id: bool = False,
) -> DataFrame:
    """The rows of `docs` that `index` keeps, with all their columns.

    Of rows with different texts under one id, each is kept or not for its own text. Rows without an
    id stay only if `without_id` is set.
    """
    kept = index.decide(docs, load_id, id_col, text_col).filter("kept").select("key")
    return kept_rows(docs, materialise(kept, "kept"), id_col, text_col, without_id)
