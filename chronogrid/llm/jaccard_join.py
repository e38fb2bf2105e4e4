"""Exact n-gram Jaccard self-join by universe partition and pigeonhole.

Two sets of sizes r and s with Jaccard similarity of at least t differ in at most
H = (1 - t) / (1 + t) * (r + s) elements. The universe of shingle hashes is cut into m
segments; a pair that differs in at most H elements agrees on at least m - H of them.
A set's subset in each non-empty segment is hashed to one signature. Sets are taken by
size band (factor two), with one scheme inside a band and one across each border, so
each scheme's m fits the sizes it serves.

Allocation. A non-empty segment without deletions is worth one difference to a set: a
pair that meets nowhere differs there by one element at least. A segment of two elements
or more whose one-deletion neighbourhood is emitted as well is worth two. A set whose
non-empty segments alone are not worth H + 1 emits the neighbourhoods of as many
segments as it takes, in the order of the segments' numbers. So of two sets, the one that
emits more has all neighbourhoods that the other counts on, and the other's worth of
H + 1 says that they meet. Sets whose worth falls short even so emit their single
elements too, of which similar sets share one. m is chosen by the expected cost of it all.
No step of this rests on chance. Every agreement is a candidate only.

Shingles are told apart by 64-bit hashes, in the sets as in the decision on a pair. That
hashing errs on a pair of r and s shingles (calls two different shingles equal) has a
chance of some (r + s)^2 / 2^65: under 10^-13 for a thousand shingles each.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import mix64, saved, text_slices
from .components import components
from .shingles import shingle_sets

#: Fewest bits of the map by which far pairs are told apart before their sets are compared.
SKETCH = 256
#: Rows of signatures that are looked at together; a centre with more is split, by signature or by its sets.
TOGETHER = 2_000
#: A family of sets is split into blocks of at least BLOCK sets, and into BLOCKS blocks at most.
BLOCK, BLOCKS = 512, 64
#: Sets of which a task notes the pairs that it has tested, in some 64 MB.
NOTED = 8_192
_SALTS = mix64(np.arange(1, 9, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _most(n, top, num: int, den: int):
    """Largest size of a partner of a set of size n, at most ``top``; the bound H of such a pair."""
    partner = np.minimum(top, n * den // num)
    return (den - num) * (n + partner) // (den + num)


@lru_cache(maxsize=None)
def segments(low: int, high: int, top: int, num: int, den: int) -> int:
    """m of least expected cost for sizes low..high whose partners have at most ``top`` elements.

    Cost of a size: its non-empty segments, the neighbourhoods that make up for the
    segments it may lack, and its elements if these don't either.
    """
    n = np.unique(np.linspace(low, high, 16).astype(np.int64)).astype(float)
    need = _most(n.astype(np.int64), top, num, den) + 1.0
    best = (math.inf, 1)
    m = max(1, int(need.max()) // 2)
    while m <= 4 * need.max() + 4:
        filled = m * (1 - (1 - 1 / m) ** n) if m > 1 else np.minimum(n, 1.0)
        spread = np.sqrt(np.maximum(filled * (1 - filled / m), 1e-9))
        single = np.minimum(filled, n * (1 - 1 / m) ** (n - 1) if m > 1 else (n == 1).astype(float))
        double = np.maximum(filled - single, 1e-9)
        cost = float((filled + _beyond(need, filled, spread) * (n - single) / double + _over(need, filled + double, spread) * n).sum())
        if cost < best[0]:
            best = (cost, m)
        m += max(1, m // 100)
    return best[1]


def _over(bound: np.ndarray, mean: np.ndarray, spread: np.ndarray) -> np.ndarray:
    """Chance that a normal variable is under ``bound``."""
    return np.array([0.5 * math.erfc((f - k + 0.5) / (s * math.sqrt(2))) for f, k, s in zip(mean, bound, spread, strict=True)])


def _beyond(bound: np.ndarray, mean: np.ndarray, spread: np.ndarray) -> np.ndarray:
    """Mean of what a normal variable lacks of ``bound``."""
    z = (bound - mean) / spread
    return (bound - mean) * _over(bound, mean, spread) + spread * np.exp(-z * z / 2) / math.sqrt(2 * math.pi)


def _emit(h: np.ndarray, doc: np.ndarray, n: np.ndarray, m: np.ndarray, need: np.ndarray, salt: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of sets under one scheme. h: hashes sorted within doc; the rest by document."""
    segment = ((h >> np.uint64(32)) * m[doc] >> np.uint64(32)).astype(np.uint64)
    fresh = np.ones(len(h), bool)
    fresh[1:] = (segment[1:] != segment[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(fresh)
    value = mix64(h ^ _SALTS[0])
    total = np.add.reduceat(value, first)
    own, tag = doc[first], mix64(segment[first] * _SALTS[1] + salt[doc[first]])
    out, owner = [mix64(total ^ tag)], [own]
    lacks = need - np.bincount(own, minlength=len(n))
    if (lacks > 0).any():
        size = np.diff(np.append(first, len(h)))
        double = size > 1
        seen = np.cumsum(double) - double  # segments of two elements or more before this one, over all sets
        heads = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        before = seen - np.repeat(seen[heads], np.diff(np.append(heads, len(own))))
        at = np.cumsum(fresh) - 1
        which = (double & (before < lacks[own]))[at]
        out.append(mix64((total[at[which]] - value[which]) ^ tag[at[which]]))
        owner.append(doc[which])
        which = (np.bincount(own, double, len(n)) < lacks)[doc]
        out.append(mix64(value[which] + mix64(salt[doc[which]] ^ _SALTS[2])))
        owner.append(doc[which])
    return np.concatenate(out), np.concatenate(owner)


def signatures(h: np.ndarray, bounds: np.ndarray, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """(signature, index of the set) of all sets under the schemes that their sizes take part in."""
    n = np.diff(bounds)
    doc = np.repeat(np.arange(len(n)), n)
    band = np.zeros(len(n), np.int64)
    band[n > 0] = np.floor(np.log2(n[n > 0])).astype(np.int64)
    low, top = 1 << band, (2 << band) - 1
    found = []

    def scheme(kind: int, which: np.ndarray, border: np.ndarray, sizes, highest) -> None:
        """border names the scheme; highest: of a partner's size."""
        if not which.any():
            return
        m, need = np.ones(len(n), np.uint64), np.ones(len(n), np.int64)
        for b in np.unique(border[which]):
            here = which & (border == b)
            m[here] = segments(*sizes(int(b)), num, den)
            need[here] = _most(n[here], highest(int(b), n[here]), num, den) + 1
        take = which[doc]
        salt = mix64(border.astype(np.uint64) * _SALTS[4] + _SALTS[5 + kind])
        found.append(_emit(h[take], doc[take], np.where(which, n, 0), m, np.where(which, need, 0), salt))

    some = n > 0
    scheme(0, some, low, lambda b: (b, 2 * b - 1, 2 * b - 1), lambda b, x: 2 * b - 1)
    reach = lambda b: (-(-b * num // den), (b - 1) * den // num)  # noqa: E731  sizes that have partners across border b
    for border, upper in ((low, True), (top + 1, False)):
        least, most = reach(border)
        which = some & (border > 1) & ((n <= most) if upper else (n >= least))
        scheme(1, which, border, lambda b: (*reach(b), reach(b)[1]), lambda b, x: np.where(x < b, reach(b)[1], b - 1))
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate([x[0] for x in found]), np.concatenate([x[1] for x in found])


def _sketches(h: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    """Per set a bit map of about eight bits an element, a power of two long, with a bit set for each element's place.

    Bits in which two maps differ bound the elements in which their sets differ from
    below; a longer map is folded to the length of a shorter.
    """
    out = []
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        g = max(SKETCH, 1 << int(6 * (b - a)).bit_length())
        bits = np.zeros(g, np.uint8)
        bits[(h[a:b] & np.uint64(g - 1)).astype(np.int64)] = 1
        out.append(np.packbits(bits).tobytes())
    return out


def _folded(sketch: bytes, words: int) -> np.ndarray:
    return np.bitwise_or.reduce(np.frombuffer(sketch, np.uint64).reshape(-1, words), axis=0)


def _near(x: bytes, y: bytes, total: int, num: int, den: int) -> bool:
    """False only if sets with these maps and this sum of sizes can't be similar."""
    g = min(len(x), len(y)) // 8
    return (den + num) * int(np.bitwise_count(_folded(x, g) ^ _folded(y, g)).sum()) <= (den - num) * total


def _profiles(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        for batch in batches:
            for first, data, offsets in text_slices(batch.column(1)):
                h, bounds = shingle_sets(data, offsets, words)
                raw = data.tobytes().lower()
                keys = [hashlib.blake2b(b" ".join(raw[a:b].split()), digest_size=16).digest() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(keys)), pa.array(keys, pa.binary()), pa.array(np.diff(bounds), pa.int64()), pa.array(_sketches(h, bounds), pa.binary())], ["doc_id", "digest", "n_shingles", "sketch"])

    return run


def _signed(words: int, num: int, den: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for first, data, offsets in text_slices(batch.column(1)):
                h, bounds = shingle_sets(data, offsets, words)
                sig, owner = signatures(h, bounds, num, den)
                if len(sig):
                    yield pa.RecordBatch.from_arrays([pa.array(sig.view(np.int64)), pa.array(ids[first + owner].astype(np.int64))], ["sig", "id"])

    return run


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by (sig, id): those of signatures that several sets have, each with the smallest such id."""
    last: tuple[int, int] | None = None  # signature and its first id; its row waits for a second one
    waiting = False

    def batch(sig, ids, centre):
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (sig, ids, centre)], ["sig", "id", "centre"])

    for b in batches:
        sig, ids = (b.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
        if not len(sig):
            continue
        carried = last is not None and sig[0] == last[0]
        fresh = np.ones(len(sig), bool)
        fresh[1:] = sig[1:] != sig[:-1]
        fresh[0] = not carried
        heads = np.flatnonzero(fresh)
        group = np.cumsum(fresh) - 1
        centre = np.where(group >= 0, ids[heads[np.maximum(group, 0)]] if len(heads) else 0, last[1] if last else 0)
        other = ids != centre
        keep = other.copy()
        with_others = np.zeros(len(heads), bool)
        with_others[group[other & (group >= 0)]] = True
        keep[heads[with_others]] = True
        if waiting and carried and (other & (group < 0)).any():
            yield batch([last[0]], [last[1]], [last[1]])
            waiting = False
        if keep.any():
            yield batch(sig[keep], ids[keep], centre[keep])
        if len(heads):
            last, waiting = (int(sig[-1]), int(ids[heads[-1]])), not with_others[-1]


def _sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, offsets in text_slices(batch.column(1)):
                h, bounds = shingle_sets(data, offsets, words)
                raw = h.tobytes()
                n = len(bounds) - 1
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, n), pa.array([raw[8 * a : 8 * b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)], pa.binary())], ["id", "hashes"])

    return run


def _verified(num: int, den: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = np.concatenate((x, y))
                both.sort()
                common = int((both[1:] == both[:-1]).sum())
                keep.append(common > 0 and den * common >= num * (len(both) - common))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _plausible(num: int, den: int):
    """Of rows (a, b, sizes, sketches): the pairs that these leave open."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m, n, x, y = (batch.column(k).to_pylist() for k in range(2, 6))
            keep = [den * min(p, q) >= num * max(p, q) and _near(u, v, p + q, num, den) for p, q, u, v in zip(m, n, x, y, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


class _Family:
    """Sets that share signatures with one centre; tells which pairs of them sizes and maps leave open."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den
        self.place: dict[int, int] = {}
        self.sizes: list[int] = []
        self.maps: list[bytes] = []
        self.folds: dict[int, np.ndarray] = {}
        self.tested: np.ndarray | None = None

    def add(self, doc: int, size: int, sketch: bytes) -> None:
        self.place[doc] = len(self.sizes)
        self.sizes.append(size)
        self.maps.append(sketch)

    def _at(self, words: int) -> np.ndarray:
        """Maps of ``words`` words of all sets whose own are at least as long."""
        if words not in self.folds:
            fold = np.zeros((len(self.maps), words), np.uint64)
            for k, m in enumerate(self.maps):
                if len(m) >= 8 * words:
                    fold[k] = _folded(m, words)
            self.folds[words] = fold
        return self.folds[words]

    def pairs(self, ids: np.ndarray, comp: np.ndarray, side: np.ndarray, block: int = 1024) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Open pairs of different components; a pair that was tested under an earlier signature is not told again.

        Where sets have sides (not -1), pairs are of one that is asked for (1) and one of
        the others: of the component that asks for nothing (0), or asked for elsewhere too
        (2), which is told there if its id is the smaller one.
        """
        if self.tested is None and len(self.sizes) <= NOTED:
            self.tested = np.zeros((len(self.sizes), len(self.sizes)), bool)
        at = np.array([self.place[int(i)] for i in ids])
        size, words = np.array(self.sizes)[at], np.array([len(self.maps[k]) // 8 for k in at])
        num, den = self.num, self.den
        for i in range(0, len(ids), block):
            for j in range(i, len(ids), block):
                a, b = slice(i, i + block), slice(j, j + block)
                open_ = comp[a, None] != comp[None, b]
                if side[0] >= 0:
                    p, q, less = side[a, None], side[None, b], ids[a, None] < ids[None, b]
                    open_ &= ((p == 1) & ((q == 0) | (q == 2) & less)) | ((q == 1) & ((p == 0) | (p == 2) & ~less))
                open_ &= den * np.minimum(size[a, None], size[None, b]) >= num * np.maximum(size[a, None], size[None, b])
                if i == j:
                    open_ &= np.tri(len(at[a]), k=-1, dtype=bool).T
                if self.tested is not None:
                    open_ &= ~self.tested[at[a, None], at[None, b]]
                x, y = np.nonzero(open_)
                x, y = x + i, y + j
                if self.tested is not None:
                    self.tested[at[x], at[y]] = self.tested[at[y], at[x]] = True
                short = np.minimum(words[x], words[y])
                for w in np.unique(short):
                    p, q, fold = x[short == w], y[short == w], self._at(int(w))
                    step = max(1, (4 << 20) // (8 * int(w)))
                    for k in range(0, len(p), step):
                        u, v = p[k : k + step], q[k : k + step]
                        apart = np.bitwise_count(fold[at[u]] ^ fold[at[v]]).sum(axis=1, dtype=np.int64)
                        near = (den + num) * apart <= (den - num) * (size[u] + size[v])
                        if near.any():
                            yield ids[u[near]], ids[v[near]]


def _across(num: int, den: int):
    """Of rows (centre, part, sig, id, component, side, size, sketch), sorted, maps (null sig) before memberships: open pairs of two components under one signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = sig = family = None
        ids: list[int] = []
        comp: list[int] = []
        side: list[int] = []

        def closed():
            if len(ids) > 1 and min(comp) != max(comp):
                for x, y in family.pairs(np.array(ids), np.array(comp), np.array(side)):
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], ["a", "b"])
            ids.clear()
            comp.clear()
            side.clear()

        for b in batches:
            for centre, part, s, doc, c, half, size, sketch in zip(*(x.to_pylist() for x in b.columns), strict=True):
                if (centre, part) != key or s != sig:
                    yield from closed()
                    if (centre, part) != key:
                        family = _Family(num, den)
                    key, sig = (centre, part), s
                if s is None:
                    family.add(doc, size, sketch)
                else:
                    ids.append(doc)
                    comp.append(c)
                    side.append(half)
        yield from closed()

    return run


def _links(candidates: DataFrame, base: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """Of pairs (a, b), those whose sets are similar enough. The sets are made again from the texts of the pairs' documents alone."""
    pairs = saved(candidates, "pairs")
    ids = saved(pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct(), "ids")
    sets = saved(base.join(ids, "doc_id", "left_semi").mapInArrow(_sets(words), "id long, hashes binary"), "sets")
    # Rows that share an id have one set each; any two of them may link.
    x = sets.select(F.col("id").alias("a"), F.col("hashes").alias("x"))
    y = sets.select(F.col("id").alias("b"), F.col("hashes").alias("y"))
    full = pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y")
    return saved(full.mapInArrow(_verified(num, den), "a long, b long").distinct(), "links")


def jaccard_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, num: int = 3, den: int = 4) -> DataFrame:
    """One row per row of ``docs``: (doc_id, n_shingles, component_id).

    Documents link when the Jaccard similarity of their sets of ``words``-word shingles
    (words split at bytes 09-0D and 20, A-Z lower-cased) is at least num/den;
    component_id is the smallest id reachable by links. No candidate is capped or
    dropped, so every link that joins two components is found. Similarity is decided on
    64-bit shingle hashes, whose bound of error the module states. Sets that very many
    signatures or a very frequent one tie together are compared block by block, in many
    tasks.

    Null or empty texts, and texts of white space, have no shingles and link with nothing.
    Texts of fewer words are one shingle. Rows that share an id are one document and so
    one component. A null id stays null and is no partner. Repeated rows are each
    returned. Other columns are not read. An empty table gives no rows.
    """
    spark = docs.sparkSession
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    seen = saved(base.mapInArrow(_profiles(words), "doc_id long, digest binary, n_shingles long, sketch binary"), "profiles")
    # Copies collapse to the smallest id; the grouped minimum is combined before the shuffle.
    live = seen.where("n_shingles > 0 AND doc_id IS NOT NULL")
    firsts = saved(live.groupBy("digest").agg(F.min("doc_id").alias("id"), F.max("doc_id").alias("last")).where("id < last"), "classes")
    later = live.select("digest", "doc_id").join(firsts, "digest").where("doc_id > id").select("doc_id", F.col("id").alias("rep")).distinct()
    later = saved(later, "copies")

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    signed = base.where("doc_id IS NOT NULL").mapInArrow(_signed(words, num, den), "sig long, id long")
    rows = signed.repartition(parts, "sig").sortWithinPartitions("sig", "id")
    # A class's first text has all signatures of its copies, so no centre is a copy.
    # Copies go here, and not before, to keep whole texts out of the shuffle.
    shared = saved(rows.mapInArrow(_shared, "sig long, id long, centre long"), "shared")
    shared = saved(shared.join(later.select(F.col("doc_id").alias("id")).distinct(), "id", "left_anti"), "shared")
    profile = live.select(F.col("doc_id").alias("id"), F.col("n_shingles").alias("n"), "sketch")

    # First each set with the one centre that it shares most signatures with.
    counted = shared.where("id <> centre").groupBy("id", "centre").agg(F.count("*").alias("n"))
    best = saved(counted.groupBy("id").agg(F.max_by("centre", F.struct("n", -F.col("centre"))).alias("centre")), "best")
    both = best.join(profile, "id").join(profile.toDF("centre", "m", "other"), "centre")
    open_ = both.select(F.col("centre").alias("a"), F.col("id").alias("b"), "m", "n", "other", "sketch").mapInArrow(_plausible(num, den), "a long, b long").distinct()
    first = _links(open_, base, words, num, den).unionByName(later.select(F.col("rep").alias("a"), F.col("doc_id").alias("b")))
    comp = saved(components(first), "components")

    # Then, under each signature, whatever pairs the components leave open.
    placed = shared.distinct().join(comp.withColumnRenamed("node", "id"), "id", "left").select("centre", "sig", "id", F.coalesce("component", "id").alias("component"))
    placed = saved(placed, "placed")
    mixed = placed.groupBy("sig").agg(F.min("component").alias("p"), F.max("component").alias("q"), F.count("*").alias("sets")).where("p < q").select("sig", "sets")
    mixed = saved(placed.join(mixed, "sig"), "mixed")
    # Signatures of one centre are looked at together, for their pairs are mostly the same.
    # A centre of many rows is split in the way that compares less: by signature, or by its
    # sets. Centres to split are few: at most one for TOGETHER rows.
    rows = mixed.groupBy("centre").agg(F.count("*").alias("rows"), F.sum(F.col("sets")).alias("pairs"), F.max("sets").alias("most")).where(F.col("rows") > TOGETHER)
    big = saved(rows, "big-centres")
    family = saved(mixed.join(big.select("centre"), "centre").select("centre", "id", "component").distinct(), "families")
    kinds = family.groupBy("centre", "component").agg(F.count("*").alias("n"))
    shape = kinds.groupBy("centre").agg(F.sum("n").alias("sets"), F.max("n").alias("alike"), F.max_by("component", F.struct("n", -F.col("component"))).alias("major"))
    asked, block = F.col("sets") - F.col("alike"), F.greatest(F.lit(BLOCK), F.ceil(F.col("sets") / BLOCKS))
    whole = (F.col("pairs") > asked * F.col("sets")) | (F.col("most") > TOGETHER)
    ways = big.join(shape, "centre").select("centre", "major", whole.alias("whole"), F.ceil(F.col("rows") / TOGETHER).alias("parts"), F.ceil(asked / block).alias("down"), F.ceil(F.col("sets") / block).alias("across"))
    ways = saved(ways, "ways")
    usual = mixed.join(ways.select("centre", "whole", "parts"), "centre", "left").where("whole IS NULL OR NOT whole")
    usual = usual.withColumn("part", F.pmod(F.xxhash64("sig"), F.coalesce("parts", F.lit(1)))).withColumn("side", F.lit(-1))
    # Sets outside the component that most of the family is in already are held against
    # all of the family, one block of them and one of the family in a task.
    held = family.join(ways.where("whole"), "centre")
    numbers = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    key = F.xxhash64("id")
    down = held.where("component <> major").withColumn("i", F.pmod(key, F.col("down"))).withColumn("j", numbers("across")).withColumn("side", F.lit(1))
    over = held.withColumn("j", F.pmod(key, F.col("across"))).withColumn("i", numbers("down")).withColumn("side", F.when(F.col("component") == F.col("major"), 0).otherwise(2))
    dealt = down.unionByName(over).withColumn("part", -1 - F.col("i") * F.col("across") - F.col("j")).withColumn("sig", F.lit(0).cast("long"))
    columns = ["centre", "part", "sig", "id", "component", "side"]
    members = saved(usual.select(*columns).unionByName(dealt.select(*columns)), "members")
    none = F.lit(None)
    maps = members.select("centre", "part", "id").distinct().join(profile, "id").select("centre", "part", none.cast("long").alias("sig"), "id", none.cast("long").alias("component"), none.cast("int").alias("side"), "n", "sketch")
    rows = members.select("*", none.cast("long").alias("n"), none.cast("binary").alias("sketch")).unionByName(maps)
    left = rows.repartition(parts, "centre", "part").sortWithinPartitions("centre", "part", F.col("sig").asc_nulls_first(), "id")
    second = _links(left.mapInArrow(_across(num, den), "a long, b long").distinct(), base, words, num, den)
    comp = saved(components(first.unionByName(second)), "components")
    return seen.select("doc_id", "n_shingles").join(comp.withColumnRenamed("node", "doc_id"), "doc_id", "left").select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
