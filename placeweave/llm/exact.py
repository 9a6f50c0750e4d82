"""Exact deduplication: a streaming fold into disk-backed keyed state, then a check of full bytes.

The stream keeps, for every digest it has ever met and without expiry, one stable identifier (the largest
``doc_id``), the content locator of that row (file and row within it) and a count. The state lives in RocksDB
and is checkpointed to the shared folder, so a lost executor costs a reload and a later run goes on where the
last one stopped. Reading the state back as a table gives every row its group; rows that hit a group of several
are compared byte for byte with the text their locator points to.

Rows: a null text counts as empty, so null and empty rows form one group. Repeated rows (same identifier and text) are rows
of one group; the locator breaks the tie, so exactly one row of a group is kept. A null identifier is smaller than any other.
Other columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from placeweave.llm.shared import ascii_lower, query, stored, table_path
from placeweave.session import scratch_folder

# Keyed state on disk. Space is not claimed ahead: every state partition would hold megabytes of empty file.
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}
# Input taken up by one micro-batch; larger inputs go through the state batch by batch.
BATCH_BYTES = 1 << 40
# Digests of groups with several rows are broadcast to the byte check when there are at most this many (32 bytes each);
# with more, the check's join shuffles the texts instead.
BROADCAST_DIGESTS = 200_000


def sha256_digest(normal: Column) -> Column:
    return F.unhex(F.sha2(normal, 256))


def _located(rows: DataFrame, text: str, key: str, digest) -> DataFrame:
    """Identifier, locator, digest and normalised text of every row; nothing else is read."""
    meta = rows.metadataColumn("_metadata")
    normal = ascii_lower(F.coalesce(F.col(text), F.lit("")))
    return rows.select(F.col(key).alias("doc_id"), meta["file_path"].alias("file"), meta["row_index"].alias("row"),
                       digest(normal).alias("digest"), normal.alias("normal"))


def fold_into_state(spark: SparkSession, path: str, state: str, *, text: str = "text", key: str = "doc_id",
                    digest=sha256_digest, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """Run whatever is new under ``path`` through the keyed state in ``state``; return the state as a table.

    Columns: digest, keep_id, keep_file, keep_row, group_size. Calling it again with the same ``state`` takes up
    only files that came since.
    """
    parent, _, name = path.rstrip("/").rpartition("/")
    stream = (spark.readStream.schema(spark.read.parquet(path).schema).option("maxBytesPerTrigger", str(batch_bytes))
              .parquet(f"{parent}/{{{name}}}"))  # as a pattern, so that a table may be one file or a folder
    folded = (_located(stream, text, key, digest).groupBy("digest")
              .agg(F.max(F.struct("doc_id", "file", "row")).alias("keeper"), F.count("*").alias("group_size")))
    before = {name: spark.conf.get(name, None) for name in STATE_SETTINGS}
    for name, value in STATE_SETTINGS.items():
        spark.conf.set(name, value)
    try:
        (folded.writeStream.format("noop").outputMode("update").option("checkpointLocation", state)
         .trigger(availableNow=True).start().awaitTermination())
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    if spark.read.parquet(path).isEmpty():  # no batch ran, so there is no state to read
        return spark.createDataFrame([], "digest binary, keep_id long, keep_file string, keep_row long, group_size long")
    kept = spark.read.format("statestore").load(state)
    return kept.select("key.digest", F.col("value.max.doc_id").alias("keep_id"), F.col("value.max.file").alias("keep_file"),
                       F.col("value.max.row").alias("keep_row"), F.col("value.count").alias("group_size"))


def exact_groups(spark: SparkSession, path: str, *, state: str | None = None, text: str = "text", key: str = "doc_id",
                 digest=sha256_digest, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """One row per row of the Parquet table at ``path``: doc_id, keep_id, group_size, kept, file, row, normal's SHA-256.

    Rows are equal when their texts agree after lower-casing A-Z. The row with the largest identifier stays.
    """
    state = state or scratch_folder(spark, "exact-state")
    keepers = fold_into_state(spark, path, state, text=text, key=key, digest=digest, batch_bytes=batch_bytes)
    rows = _located(spark.read.parquet(path), text, key, digest).withColumn("text_sha256", F.sha2("normal", 256))
    is_keeper = (F.col("file") == F.col("keep_file")) & (F.col("row") == F.col("keep_row"))
    grouped = (rows.drop("normal").join(keepers, "digest")
               .select("doc_id", "keep_id", "group_size", is_keeper.alias("kept"), "text_sha256", "digest", "file", "row"))

    impostors = stored(_other_bytes(rows, keepers.where("group_size > 1")), "exact-impostors")
    if impostors.isEmpty():
        return grouped.drop("digest")
    return _regrouped(grouped, impostors).drop("digest")


def _other_bytes(rows: DataFrame, hits: DataFrame) -> DataFrame:
    """Rows whose text differs from the text at their digest's locator: true collisions of the digest."""
    wanted = hits.select("digest", "keep_file", "keep_row")
    if hits.limit(BROADCAST_DIGESTS + 1).count() <= BROADCAST_DIGESTS:
        rows = rows.join(F.broadcast(wanted.select("digest")), "digest", "left_semi")
    at_locator = (rows.join(wanted, "digest").where("file = keep_file AND row = keep_row")
                  .select("digest", F.col("normal").alias("kept_normal")))
    return (rows.join(at_locator, "digest").where("normal <> kept_normal")
            .select("doc_id", "file", "row", "digest", "normal"))


def _regrouped(grouped: DataFrame, impostors: DataFrame) -> DataFrame:
    """Group colliding rows by their own bytes and take them out of the groups that they had fallen into."""
    own = impostors.groupBy("digest", "normal").agg(
        F.max(F.struct("doc_id", "file", "row")).alias("own"), F.count("*").alias("own_size"))
    moved = impostors.join(own, ["digest", "normal"]).select(
        "file", "row", "own_size", F.col("own.doc_id").alias("own_keep"),
        ((F.col("own.file") == F.col("file")) & (F.col("own.row") == F.col("row"))).alias("own_kept"))
    less = impostors.groupBy("digest").agg(F.count("*").alias("less"))
    found = F.col("own_size").isNotNull()
    return (grouped.join(moved, ["file", "row"], "left").join(less, "digest", "left")
            .select("doc_id", F.when(found, F.col("own_keep")).otherwise(F.col("keep_id")).alias("keep_id"),
                    F.when(found, F.col("own_size")).otherwise(F.col("group_size") - F.coalesce("less", F.lit(0)))
                    .alias("group_size"),
                    F.when(found, F.col("own_kept")).otherwise(F.col("kept")).alias("kept"),
                    "text_sha256", "digest", "file", "row"))


@query("""
    WITH normal AS (
        SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
        FROM documents)
    SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
           doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
    FROM normal WINDOW w AS (PARTITION BY t)
""")
def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(spark, table_path(sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")
