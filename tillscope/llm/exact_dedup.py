"""Exact de-duplication against a persistent index of digests.

The index is a table bucketed and sorted by digest, one row per distinct text. A batch is
grouped by digest first, the groups meet the index in a sort-merge anti-join (the index is
not shuffled, as it lies in the buckets the join wants), and what is new is appended. Then
every group reads its entry from the index by a second merge join: the document that stands
for the text, and the batch that brought it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillscope.llm.grouping import SALTS
from tillscope.llm.storage import checkpointed, free_name

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def normalised(text: Column) -> Column:
    """Text as it is compared: A-Z lower-cased and nothing else; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower())


def digest_hex(text: Column) -> Column:
    """SHA-256 of the normalised text, lower-case hex."""
    return F.sha2(normalised(text), 256)


class DigestIndex:
    """Digests seen so far, with the document that stands for each."""

    def __init__(self, spark: SparkSession, table: str, buckets: int | None = None):
        """``buckets`` counts only when the table is made; it should suit the largest index."""
        self.spark = spark
        self.table = table
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.table)

    def create(self, id_type: str = "bigint") -> None:
        """Make the index, empty, if it is not there."""
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.table} (digest BINARY, keep_id {id_type}, batch STRING) "
            f"USING parquet CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS"
        )
        # A table made earlier keeps its own number of buckets, and appends must use it.
        for row in self.spark.sql(f"DESCRIBE EXTENDED {self.table}").where("col_name = 'Num Buckets'").collect():
            self.buckets = int(row["data_type"])

    def append(self, groups: DataFrame, batch: str) -> None:
        """Add the rows ``digest``, ``keep_id`` that the index has not got, a file a bucket.

        A job that fails leaves the table as it was, and running it again adds the same rows.
        """
        known = self.spark.table(self.table).select("digest")
        rows = groups.select("digest", "keep_id").hint("merge").join(known.hint("merge"), "digest", "left_anti")
        (
            rows.withColumn("batch", F.lit(batch)).repartition(self.buckets, "digest")
            .write.format("parquet").mode("append")
            .bucketBy(self.buckets, "digest").sortBy("digest").saveAsTable(self.table)
        )

    def entries(self, groups: DataFrame) -> DataFrame:
        """``groups`` with ``keep_id`` and ``batch`` as the index has them; it is not shuffled."""
        return groups.hint("merge").join(self.spark.table(self.table).hint("merge"), "digest")

    def deduplicate(self, docs: DataFrame, batch: str | None = None) -> DataFrame:
        """Digest, representative and fate of every row of ``docs``; new texts enter the index.

        Columns: ``doc_id``, ``keep_id``, ``group_size`` (rows of this batch with the text),
        ``kept``, ``text_sha256``. Among equal texts of a batch the largest doc_id stays; a text
        the index already has is dropped in favour of the document recorded there. Null and empty
        texts are one text. A null doc_id is smaller than any other. Rows repeated under one
        doc_id: one of them is kept. An empty table gives an empty result. The result does not
        change when the index grows or goes. A ``batch`` that is named can be run again, after a
        loss of its result, with the same outcome; without a name each call is a batch of its own.
        """
        batch = batch or uuid.uuid4().hex
        self.create(docs.schema["doc_id"].dataType.simpleString())
        # Equal rows cannot be told apart, so a number marks the one that is kept; the
        # checkpoint fixes the numbers, whatever order the rows came in.
        rows = checkpointed(docs.select(
            "doc_id", F.unhex(digest_hex(F.col("text"))).alias("digest"),
            F.monotonically_increasing_id().alias("row"),
        ))
        groups = checkpointed(rows.groupBy("digest").agg(
            F.max(F.struct("doc_id", "row")).alias("best"), F.count("*").alias("group_size")
        ))
        self.append(groups.select("digest", F.col("best.doc_id").alias("keep_id")), batch)
        found = checkpointed(self.entries(
            groups.select("digest", F.col("best.row").alias("first_row"), "group_size")
        ))
        # Rows read their group's entry by digest and salt, so a large group is many small keys.
        salted = rows.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int"))
        spread = salted.select("digest", "salt").distinct().join(found, "digest")
        return salted.join(spread, ["digest", "salt"]).select(
            "doc_id", "keep_id", "group_size",
            ((F.col("row") == F.col("first_row")) & (F.col("batch") == batch)).alias("kept"),
            F.lower(F.hex("digest")).alias("text_sha256"),
        )

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")


def deduplicate_once(docs: DataFrame) -> DataFrame:
    """``DigestIndex.deduplicate`` of one batch against an index made for it and dropped again.

    The index is empty at first; every row gets its outcome from the index all the same.
    """
    index = DigestIndex(docs.sparkSession, f"digests_{uuid.uuid4().hex}")
    try:
        return index.deduplicate(docs)
    finally:
        index.drop()


def without_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, all columns as they were.

    Rows are matched to their fate by doc_id and digest; of rows repeated in both, one stays.
    """
    node, digest, own = (free_name(docs, n) for n in ("kept_id", "kept_digest", "own_digest"))
    fate = deduplicate_once(docs).where("kept").select(
        F.col("doc_id").alias(node), F.col("text_sha256").alias(digest)
    )
    marked = docs.withColumn(own, digest_hex(F.col("text")))
    once = marked.join(
        fate, F.col("doc_id").eqNullSafe(F.col(node)) & (F.col(own) == F.col(digest)), "left_semi"
    )
    return once.dropDuplicates(["doc_id", own]).select(*docs.columns)
