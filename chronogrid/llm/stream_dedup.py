"""Exact deduplication by a stateful stream.

Files of documents stream in. A keyed state without expiry, kept on disk by RocksDB, holds for every digest its
smallest id, the content locator (file and row) of that document, and the number of
rows. A digest is only a hint: rows that hit a digest are held against the full text at
the locator, and rows whose text differs form groups of their own. That is done for all
micro-batches in one join when the stream has read the files, and not batch by batch:
a table's files give no access to a row by its place, so that each batch would read the
older files again.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import saved, settings, work_dir

_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Micro-batches that the files are dealt to, where their number is not given.
BATCHES = 4
#: Bits of the map of repeated digests, at most (16 MB); rows outside it keep their texts out of the shuffle.
MAP_BITS = 1 << 27
_BUCKET = 1 << 15  # bits that one bitmap of Spark's holds
_OUT = "digest string, id long, locator string, copies long"


def normalised(text) -> F.Column:
    """Each run of bytes 09-0D and 20 becomes one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _located(df: DataFrame, id_col: str, text_col: str, digest_hex: int) -> DataFrame:
    text = normalised(F.col(text_col))
    located = df.select(F.col(id_col).cast("long").alias("id"), text.alias("text"), F.format_string("%s#%d", F.col("_metadata.file_path"), F.col("_metadata.row_index")).alias("locator"))
    located = located.withColumn("text_sha256", F.sha2("text", 256))
    return located.withColumn("digest", F.substring("text_sha256", 1, digest_hex))


def literal(path: str) -> str:
    """``path`` as a pattern that matches itself alone, whatever characters it has; as a pattern, a single file will do for a folder."""
    path = path.rstrip("/")
    escaped = re.sub(r"([*?{}\[\]\\])", r"\\\1", path)
    return escaped if escaped != path else f"{path[:-1]}[{path[-1]}]"


def _marked(digests: DataFrame) -> tuple[DataFrame, int]:
    """Bitmaps (bucket, bits) with a bit for each digest, and how many bits there are in all: some 16 a digest, MAP_BITS at most.

    A digest that is not there meets a set bit with a chance of a sixteenth, or more where MAP_BITS bounds the map.
    """
    size = min(MAP_BITS, max(_BUCKET, 1 << (16 * digests.count() - 1).bit_length()))
    place = F.pmod(F.xxhash64("digest"), F.lit(size))
    bits = digests.select((place / _BUCKET).cast("long").alias("bucket"), (place % _BUCKET).alias("bit"))
    return bits.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits")), size


def _only_texts_of(docs: DataFrame, digests: DataFrame) -> DataFrame:
    """``docs`` with texts of null where the digest is surely none of ``digests``."""
    marks, size = _marked(digests)
    place = F.pmod(F.xxhash64("digest"), F.lit(size))
    found = docs.withColumn("bucket", (place / _BUCKET).cast("long")).join(F.broadcast(marks), "bucket", "left")
    byte = F.conv(F.hex(F.expr(f"substring(bits, int(pmod(xxhash64(digest), {size}) % {_BUCKET} DIV 8) + 1, 1)")), 16, 10).cast("int")
    met = F.getbit(byte, (place % 8).cast("int")) == 1
    return found.withColumn("text", F.when(met, F.col("text"))).drop("bucket", "bits")


def digest_classes(spark: SparkSession, path: str, id_col: str, text_col: str, files_per_batch: int | None, digest_hex: int) -> DataFrame:
    """Run the stream over all files at ``path``; returns (digest, id, locator, copies), one row for each digest.

    The state is that of a streaming aggregation by digest, so a task's rows of one
    text are folded before they reach it. Each micro-batch writes the states it changed.
    """
    parts = str(4 * spark.sparkContext.defaultParallelism)  # a store has a fixed cost, whatever it holds
    sink, log = work_dir(spark, "dedup-classes"), work_dir(spark, "dedup-log")
    with settings(spark, spark__sql__streaming__stateStore__providerClass=_ROCKSDB, spark__sql__streaming__internal__stateStore__partitions=parts):
        table = spark.read.parquet(literal(path))
        each = files_per_batch or max(1, -(-len(table.inputFiles()) // BATCHES))
        stream = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", each).parquet(literal(path))
        located = _located(stream, id_col, text_col, digest_hex).select("digest", "id", "locator")
        # A null id comes last, so it is known by a smallest id that is null.
        least = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "locator")).alias("least")
        states = located.groupBy("digest").agg(least, F.count("*").alias("copies"))

        def write(batch: DataFrame, number: int) -> None:
            batch.select("digest", "least.id", "least.locator", "copies").write.mode("overwrite").parquet(f"{sink}/batch={number}")

        query = states.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", log).trigger(availableNow=True).start()
        query.awaitTermination()
    # Each micro-batch that met a digest left a row; the one with most copies is the last.
    rows = spark.read.schema(_OUT).option("recursiveFileLookup", "true").parquet(sink)
    return rows.groupBy("digest").agg(F.max_by(F.struct("id", "locator"), "copies").alias("x"), F.max("copies").alias("copies")).select("digest", "x.id", "x.locator", "copies")


def exact_dedup(spark: SparkSession, path: str, id_col: str = "doc_id", text_col: str = "text", files_per_batch: int | None = None, digest_hex: int = 64) -> DataFrame:
    """One row per row of the Parquet table at ``path``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are identical after each run of white space (bytes 09-0D
    and 20) has become one space; null counts as empty. Of equal texts the row with the
    smallest id is kept, and of rows that repeat that id the one with the smallest
    locator. A null id is kept only if its group has no other. Other columns are not
    read; an empty table gives no rows. ``digest_hex`` shortens the digest that the state
    is keyed by, which changes the work and not the result. Files come in micro-batches
    of ``files_per_batch``, or in BATCHES of them; any characters may be in ``path``.
    Settings that the stream needs are the session's only while it runs.
    """
    classes = saved(digest_classes(spark, path, id_col, text_col, files_per_batch, digest_hex).where("copies > 1"), "dedup-states")
    docs = _only_texts_of(_located(spark.read.parquet(literal(path)), id_col, text_col, digest_hex), classes.select("digest"))
    keep = classes.select("digest", F.col("id").alias("keep_id"), F.col("locator").alias("keep_locator"), "copies")
    # Digests are joined; a text travels with its digest only where that was hit (or its bit of the map is set).
    placed = docs.join(keep.hint("merge"), "digest", "left").withColumn("text", F.when(F.col("copies").isNotNull(), F.col("text")))
    placed = saved(placed, "dedup-placed")
    alone = placed.where("copies IS NULL").select(F.col("id").alias("doc_id"), F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "text_sha256")

    hits = placed.where("copies IS NOT NULL")
    first = hits.where("locator = keep_locator").select("digest", F.col("text").alias("keep_text"))
    checked = hits.join(first, "digest").withColumn("same", F.col("text") == F.col("keep_text")).drop("keep_text", "keep_locator")
    checked = saved(checked, "dedup-checked")
    other = checked.where("NOT same")
    strays = saved(other.groupBy("digest", "text").agg(F.min_by(F.struct("id", "locator"), F.struct(F.col("id").isNull(), "id", "locator")).alias("x"), F.count("*").alias("n")), "dedup-strays")
    fewer = strays.groupBy("digest").agg(F.sum("n").alias("n"))
    same = checked.where("same").join(fewer, "digest", "left").select("id", "locator", "keep_id", (F.col("copies") - F.coalesce("n", F.lit(0))).alias("group_size"), "text_sha256", "digest")
    same = same.join(keep.select("digest", "keep_locator"), "digest").select("id", "keep_id", "group_size", (F.col("locator") == F.col("keep_locator")).alias("kept"), "text_sha256")
    apart = other.select("digest", "text", "id", "locator", "text_sha256").join(strays, ["digest", "text"]).select("id", F.col("x.id").alias("keep_id"), F.col("n").alias("group_size"), (F.col("locator") == F.col("x.locator")).alias("kept"), "text_sha256")
    return alone.unionByName(same.unionByName(apart).withColumnRenamed("id", "doc_id"))
