"""Mixing sources to target weights, by fixed-length blocks.

Each source's words, document after document, fill blocks of a fixed number of words.
The mix is a row of output shards; a shard's number of slots for each source is a
multinomial draw from what the sources still owe, made for groups of shards first and
then, in tasks, for the shards of each group. Slot j of a source goes to block
perm(j mod blocks) of its pass j div blocks, with a pseudorandom permutation of the
block numbers for each source and pass, and slots meet blocks in a join by number.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .common import bounded, saved

#: Words in a block.
BLOCK = 128
#: Fewest slots of a shard, most shards, and most groups of shards.
SHARD_SLOTS, SHARDS, GROUPS = 4096, 4096, 64
#: Weights of the sources, repeated, and the mix's share of all words; no source beyond CAP times its size.
WEIGHTS, SHARE, CAP = (3, 1, 2), 1.5, 2.0
WORD = r"[^\x20\x09-\x0D]+"


def targets(sizes: dict[str | None, int], weights: tuple = WEIGHTS, share: float = SHARE, cap: float = CAP) -> dict[str | None, float]:
    """Words wanted of each source.

    Sources in code-point order, null last, take the weights in turn and share
    ``share`` times all words; a target stops at ``cap`` times its source's size, and
    the excess is shared again by weight until none is above.
    """
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    fixed: dict = {}
    total = share * sum(sizes.values())
    while True:
        free = [s for s in order if s not in fixed]
        left, all_ = total - sum(fixed.values()), sum(weight[s] for s in free)
        found = {s: left * weight[s] / all_ for s in free}
        over = [s for s in free if found[s] > cap * sizes[s]]
        if not over:
            return fixed | found
        fixed |= {s: cap * sizes[s] for s in over}
        if len(fixed) == len(order):
            return fixed


def draws(owed: np.ndarray, sizes: list[int], seed: tuple) -> Iterator[np.ndarray]:
    """For each bin, of the sizes given, a multinomial draw of slots by source from what the sources still owe; the bins take all that is owed."""
    rng, owed = np.random.default_rng(seed), owed.astype(np.int64).copy()
    for size in sizes:
        counts = np.zeros(len(owed), np.int64)
        while (want := size - int(counts.sum())) > 0:
            open_ = owed - counts
            counts += np.minimum(rng.multinomial(want, open_ / open_.sum()), open_)
        owed -= counts
        yield counts


def _groups(slots: np.ndarray, seed: int) -> list[tuple[int, int, bytes, bytes]]:
    """(first shard, slots of a full shard, slots by source before the group, and in it) of groups of shards that follow one another.

    The driver draws for groups alone, of which there are GROUPS at most; a task draws for the shards of one group.
    """
    total = int(slots.sum())
    size = max(SHARD_SLOTS, -(-total // SHARDS))
    shards = -(-total // size)
    each = max(1, -(-shards // GROUPS))
    sizes = [min(each * size, total - a) for a in range(0, total, each * size)]
    given, out = np.zeros(len(slots), np.int64), []
    for k, counts in enumerate(draws(slots, sizes, (seed, 0))):
        out.append((k * each, size, given.tobytes(), counts.tobytes()))
        given = given + counts
    return out


def shard_draws(first_shard: int, size: int, given: bytes, counts: bytes, seed: int) -> Iterator[tuple[int, int, int, int]]:
    """(shard, source, first slot, slots) of the shards of a group."""
    given, counts = np.frombuffer(given, np.int64).copy(), np.frombuffer(counts, np.int64)
    total = int(counts.sum())
    for k, drawn in enumerate(draws(counts, [min(size, total - a) for a in range(0, total, size)], (seed, 1, first_shard))):
        yield from ((first_shard + k, int(s), int(given[s]), int(drawn[s])) for s in np.flatnonzero(drawn))
        given += drawn


def permuted(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """A keyed bijection of 0..n-1: four Feistel rounds on the next even power of two, walked until inside."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    keys = [np.uint64(int.from_bytes(hashlib.blake2b(f"{key}/{r}".encode(), digest_size=8).digest(), "little")) for r in range(4)]
    x = index.astype(np.uint64)
    outside = np.ones(len(x), bool)
    while outside.any():
        a, b = x[outside] >> np.uint64(half), x[outside] & mask
        for k in keys:
            f = (b ^ k) * np.uint64(0x9E3779B97F4A7C15)
            f = (f ^ (f >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            a, b = b, a ^ ((f >> np.uint64(32)) & mask)
        x[outside] = (a << np.uint64(half)) | b
        outside[outside] = x[outside] >= np.uint64(n)
    return x.astype(np.int64)


def _slots(blocks: list[int], seed: int):
    """Groups of shards -> their slots. ``blocks``: how many a source has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["shard", "source_no", "slot", "pass", "block"]
        for batch in batches:
            for group in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held, rows = 0, []
                for shard, source, first, count in shard_draws(*group, seed):
                    n = blocks[source]
                    for a in range(first, first + count, 1 << 16):
                        j = np.arange(a, min(a + (1 << 16), first + count))
                        rounds, block = j // n, np.empty(len(j), np.int64)
                        for r in np.unique(rounds):
                            here = rounds == r
                            block[here] = permuted(j[here] % n, n, (seed * 1_000_003 + source) * 1_000_003 + int(r))
                        rows.append((np.full(len(j), shard), np.full(len(j), source), j, rounds, block))
                        held += len(j)
                        if held >= 1 << 16:
                            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*rows, strict=True)], names)
                            held, rows = 0, []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*rows, strict=True)], names)

    return run


class Mix:
    """The plan of a mix of ``docs`` (doc_id, source, text).

    ``placed``: every document with its size and the place of its first word among its
    source's words; ``slots``: shard, source_no, slot, pass, block; ``pieces``: which
    words of which documents fill a block; ``sources``: the sources' sizes and targets.

    Null texts have no words, null is a source of its own. Repeated rows are documents
    of their own. Other columns are not read. An empty table, or one without words,
    gives an empty mix. Sources are a catalogue and their sums go to the driver: more
    than ``most_sources`` of them raise ValueError.
    """

    def __init__(self, docs: DataFrame, seed: int = 17, most_sources: int = 10_000):
        spark: SparkSession = docs.sparkSession
        text = F.coalesce(F.col("text").cast("string"), F.lit(""))
        sized = saved(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"), F.xxhash64(text).alias("text_key")), "sizes")
        sums = sized.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("n")).limit(most_sources + 1).collect()
        if len(sums) > most_sources:
            raise ValueError(f"more than {most_sources} sources")
        sizes = {r["source"]: int(r["size"]) for r in sums}
        want = targets(sizes) if sizes else {}
        order = sorted(sizes, key=lambda s: (s is None, s or ""))
        blocks = np.array([-(-sizes[s] // BLOCK) for s in order], np.int64)
        # A source's last block may be short: slots are counted by its mean block.
        slots = np.array([min(int(CAP) * int(n), round(want[s] * int(n) / sizes[s])) if n else 0 for s, n in zip(order, blocks, strict=True)], np.int64)
        rows = [(s, k, sizes[s], float(want[s]), int(blocks[k])) for k, s in enumerate(order)]
        self.sources = spark.createDataFrame(rows, "source string, source_no long, source_size long, target double, blocks long")

        # Two-level running sums: a source may own most documents, so its rows are dealt
        # to groups by a hash and only the groups' totals meet in one place.
        # With as many groups as a group has documents, neither level grows beyond the root.
        parts = max(1, math.isqrt(sum(int(r["n"]) for r in sums)))
        dealt = sized.join(F.broadcast(self.sources.select("source", "source_no")), sized["source"].eqNullSafe(self.sources["source"])).drop(self.sources["source"]).withColumn("part", F.pmod(F.xxhash64("doc_id", "text_key"), F.lit(parts)))
        totals = dealt.groupBy("source_no", "part").agg(F.sum("size").alias("words"))
        before = Window.partitionBy("source_no").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        bases = totals.select("source_no", "part", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("base"))
        inside = Window.partitionBy("source_no", "part").orderBy("doc_id", "text_key", "size").rowsBetween(Window.unboundedPreceding, -1)
        self.placed = saved(dealt.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(bases, ["source_no", "part"]).select("doc_id", "source", "source_no", "text_key", "size", (F.col("base") + F.col("inside")).alias("start")), "placed")

        # At most GROUPS rows, two numbers a source each; the shards' draws are made in tasks.
        groups = spark.createDataFrame(_groups(slots, seed), "first_shard long, size long, given binary, counts binary")
        self.slots = groups.repartition(GROUPS, "first_shard").mapInArrow(_slots(blocks.tolist(), seed), "shard long, source_no long, slot long, pass long, block long")
        number = F.explode(F.sequence(F.expr(f"start DIV {BLOCK}"), F.expr(f"(start + size - 1) DIV {BLOCK}")))
        cut = self.placed.where("size > 0").select("doc_id", "source_no", "text_key", "start", "size", number.alias("block"))
        low, high = F.greatest(F.lit(0), F.col("block") * BLOCK - F.col("start")), F.least(F.col("size"), (F.col("block") + 1) * BLOCK - F.col("start"))
        self.pieces = cut.select("doc_id", "source_no", "text_key", "start", "block", low.alias("first_word"), (high - low).alias("words"))

    def rows(self) -> DataFrame:
        """The mix: shard, slot, pass, source_no, block, doc_id, text_key, start, first_word, words. A block of several documents has a row for each."""
        # Both sides grow with the input, whatever the planner takes their sizes for.
        return self.slots.join(self.pieces.hint("merge"), ["source_no", "block"])

    def taken(self) -> DataFrame:
        """Per document: doc_id, size, source_size, target, taken (words that the mix takes of it, repeats counted)."""
        took = self.rows().groupBy("source_no", "start").agg(F.sum("words").alias("taken"))
        some = self.placed.where("size > 0").join(took.hint("merge"), ["source_no", "start"], "left")
        all_ = some.unionByName(self.placed.where("size = 0"), allowMissingColumns=True)
        return all_.join(F.broadcast(self.sources.select("source_no", "source_size", "target")), "source_no").select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))

    def texts(self, docs: DataFrame) -> DataFrame:
        """Rows of ``docs`` as the mix has them: for each pass that takes words of a document, a row with these words.

        ``text`` keeps the white space inside runs of words that follow one another, and
        joins runs by a newline; n_chars, if there, is counted anew; other columns stay.
        Documents of which nothing is taken are not in the mix.
        """
        took = self.rows().groupBy("source_no", "start", "pass").agg(F.sort_array(F.collect_list(F.struct("first_word", "words"))).alias("__runs"))
        took = took.join(self.placed.where("size > 0").hint("merge"), ["source_no", "start"]).select("doc_id", "text_key", "start", "source_no", "pass", "__runs")
        # Rows that repeat an id and a text are alike: the n-th of them takes the n-th place.
        nth = took.select("doc_id", "text_key", "source_no", "start", "pass", "__runs", F.dense_rank().over(Window.partitionBy("doc_id", "text_key").orderBy("source_no", "start")).alias("__nth"))
        took = nth.select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"), "__nth", "__runs")
        rows = bounded(docs).withColumn("__key", F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))))
        rows = rows.withColumn("__nth", F.row_number().over(Window.partitionBy("doc_id", "__key").orderBy(F.col("source").asc_nulls_last())))
        joined = rows.alias("d").join(took.alias("t"), F.col("d.doc_id").eqNullSafe(F.col("t.__id")) & (F.col("d.__key") == F.col("t.__key")) & (F.col("d.__nth") == F.col("t.__nth"))).select("d.*", "t.__runs")
        out = joined.withColumn("text", F.pandas_udf(_cut, "string")("text", "__runs"))
        if "n_chars" in docs.columns:
            out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
        return out.select(*docs.columns)


def _cut(text: pd.Series, runs: pd.Series) -> pd.Series:
    import re

    word = re.compile(WORD)
    out = []
    for t, rs in zip(text, runs, strict=True):
        spans = [m.span() for m in word.finditer(t or "")]
        merged: list[list[int]] = []
        for r in rs:
            a, b = int(r["first_word"]), int(r["first_word"]) + int(r["words"])
            if merged and merged[-1][1] == a:
                merged[-1][1] = b
            else:
                merged.append([a, b])
        out.append("\n".join(t[spans[a][0] : spans[b - 1][1]] for a, b in merged))
    return pd.Series(out)


def mix(docs: DataFrame, seed: int = 17) -> Mix:
    return Mix(docs, seed)
