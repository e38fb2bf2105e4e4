"""Benchmark decontamination by pigeonhole edit matching.

A test item of n characters may be met with up to k = floor(n * rate) edits. It is cut
into k + 1 pieces, of which at least one survives k edits unchanged. All pieces of all
items are found in a text at once by an Aho-Corasick automaton; around each hit the item
is verified by Myers' bit-parallel edit distance.

Items are written to shared storage in blocks of bounded size, and a worker reads the
block it matches with: no item passes through the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import bounded, open_fs, saved, work_dir

#: Edits allowed, as a share of an item's characters.
RATE = 0.08
#: Characters of items that one automaton may hold; more items are matched in several blocks, one pass each.
BLOCK_CHARS = 4_000_000

MATCHES = "item_id long, distance int, at long"


def normalise(text: str) -> str:
    """Lower case, each run of white space one space, none at the ends."""
    return " ".join(text.lower().split())


def pieces(item: str, rate: float = RATE) -> list[tuple[int, str]]:
    """(offset, piece): k + 1 pieces of nearly equal length for k allowed edits."""
    parts = int(len(item) * rate) + 1
    cuts = [len(item) * j // parts for j in range(parts + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def myers(pattern: str, text: str, most: int) -> tuple[int, int] | None:
    """(distance, end) of the best place of ``pattern`` in ``text`` (the first of equals), None beyond ``most`` edits.

    Column by column, a pattern's vertical differences are the bits of two integers.
    """
    m = len(pattern)
    masks: dict[str, int] = {}
    for k, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << k
    full, high = (1 << m) - 1, 1 << (m - 1)
    up, down, distance = full, 0, m
    best = (m, 0)
    for end, c in enumerate(text, 1):
        eq = masks.get(c, 0)
        diagonal = (((eq & up) + up) ^ up) | eq | down
        right, left = down | (~(diagonal | up) & full), up & diagonal
        if right & high:
            distance += 1
        elif left & high:
            distance -= 1
        right, left = (right << 1) & full, (left << 1) & full
        up, down = left | (~(diagonal | right) & full), right & diagonal
        if distance < best[0]:
            best = (distance, end)
    return best if best[0] <= most else None


class Matcher:
    """Finds items in texts. Items are (id, text) or (id, text, how often it is wanted); empty ones and null ids match nothing."""

    def __init__(self, items: list[tuple], rate: float = RATE):
        import ahocorasick

        known = [(i, normalise(t), n[0] if n else 1) for i, t, *n in items if i is not None and t]
        self.items = [(i, t) for i, t, _ in known if t]
        self.times = [n for _, t, n in known if t]
        self.most = [int(len(t) * rate) for _, t in self.items]
        places: dict[str, list[tuple[int, int]]] = {}
        for k, (_, t) in enumerate(self.items):
            for offset, piece in pieces(t, rate):
                places.setdefault(piece, []).append((k, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, where in places.items():
            self.automaton.add_word(piece, (len(piece), where))
        if places:
            self.automaton.make_automaton()
        self.any = bool(places)

    def find(self, text: str) -> list[tuple[int, int, int]]:
        """(item id, least distance, end of it in the normalised text) of all items that the text has within their edits."""
        if not self.any or not text:
            return []
        t = normalise(text)
        windows: dict[int, list[list[int]]] = {}
        for end, (length, where) in self.automaton.iter(t):
            for k, offset in where:
                start = end + 1 - length - offset
                most, n = self.most[k], len(self.items[k][1])
                a, b = max(0, start - most), min(len(t), start + n + most)
                if b - a < n - most:
                    continue
                seen = windows.setdefault(k, [])
                # Hits of one passage have windows that overlap; they become one.
                if seen and a <= seen[-1][1] and b >= seen[-1][0]:
                    seen[-1][0], seen[-1][1] = min(a, seen[-1][0]), max(b, seen[-1][1])
                else:
                    seen.append([a, b])
        found = []
        for k, spans in windows.items():
            best = None
            for a, b in spans:
                hit = myers(self.items[k][1], t[a:b], self.most[k])
                if hit and (best is None or (hit[0], a + hit[1]) < best):
                    best = (hit[0], a + hit[1])
                    if not best[0]:
                        break
            if best:
                found += [(self.items[k][0], *best)] * self.times[k]
        return sorted(found)


def _blocks(items: DataFrame) -> list[str]:
    """Folders of the items' blocks on shared storage, each of some BLOCK_CHARS characters; more than one only where the benchmark is larger."""
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("item_id IS NOT NULL AND text <> ''")
    rows = rows.groupBy("item_id", "text").agg(F.count("*").alias("times"))
    total = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = -(-int(total) // BLOCK_CHARS) or 1
    folder = work_dir(items.sparkSession, "items")
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    dealt.repartition("block").write.mode("overwrite").partitionBy("block").parquet(folder)
    return [f"{folder}/block={k}" for k in range(blocks)]


_matchers: dict[tuple[str, float], Matcher] = {}


def _matcher(block: str, rate: float) -> Matcher:
    """The matcher of a block's items; a worker keeps the last one."""
    if (block, rate) not in _matchers:
        import pyarrow.parquet as pq
        from pyarrow.fs import FileSelector

        fs, path = open_fs(block)
        items = []
        for f in sorted(fs.get_file_info(FileSelector(path, allow_not_found=True)), key=lambda f: f.path):
            if f.path.endswith(".parquet"):
                with fs.open_input_file(f.path) as source:
                    items += pq.read_table(source, columns=["item_id", "text", "times"]).to_pylist()
        _matchers.clear()
        _matchers[block, rate] = Matcher([(x["item_id"], x["text"], x["times"]) for x in items], rate)
    return _matchers[block, rate]


def _matched(block: str, rate: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = _matcher(block, rate)
        for batch in batches:
            rows = [(d, *m) for d, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for m in matcher.find(t or "")]
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], ["doc_id", "item_id", "distance", "at"])

    return run


def matches(docs: DataFrame, items: DataFrame, rate: float = RATE) -> DataFrame:
    """(doc_id, item_id, distance, at): test items met in documents within their edits.

    Texts and items are lower-cased and their white space collapsed. ``distance`` is the
    least edit distance of the item to any place of the text and ``at`` where the first
    such place ends, in the normalised text. Whole texts are searched. Null and empty
    texts and items match nothing; items with a null id are left out; items that repeat
    an id are looked for each, and rows that repeat a document are each searched. An item
    is a run of characters and not of words: one of a few characters is met in every text
    that has these, inside words too, and allows no edits under 1 / rate characters. Other
    columns are not read. An empty table on either side gives no rows.
    """
    base = bounded(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")))
    out = None
    for block in _blocks(items):
        found = base.mapInArrow(_matched(block, rate), f"doc_id long, {MATCHES}")
        out = found if out is None else out.unionByName(found)
    return out


def _clean(block: str, rate: float):
    def run(text: pd.Series) -> pd.Series:
        matcher = _matcher(block, rate)
        return pd.Series([not matcher.find(t or "") for t in text], dtype=bool)

    return run


def decontaminated(docs: DataFrame, items: DataFrame, rate: float = RATE) -> DataFrame:
    """The rows of ``docs``, all columns, whose texts hold no test item within its edits.

    Decided row by row, without a join. Null and empty texts stay.
    """
    docs = bounded(docs)
    for k, block in enumerate(_blocks(items)):
        # A table between passes, so that no worker holds the items of two blocks.
        docs = (saved(docs, "decontaminated") if k else docs).where(F.pandas_udf(_clean(block, rate), "boolean")(F.col("text").cast("string")))
    return docs
