"""Line deduplication by a log-template tree.

A line falls to a leaf of a fixed-depth tree: its number of tokens, then its first
tokens, where tokens with a digit are a variable field. Inside a leaf a token is
constant if enough documents have it at its place; the others are generalised to a
variable field, and what is left is the line's template. Templates that recur in enough
documents, and are constant for the most part, are dropped with all their lines.

The tree is built by counting, so it does not depend on the order of lines and no leaf
has to fit in one task.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import bounded, saved

#: Leading tokens that the tree looks at; documents that make a token constant and a
#: template recur; share of a template's tokens that are constant.
DEPTH, RECURS, CONSTANT = 3, 5, 0.5
FIELD = "<*>"
_DIGIT = re.compile(r"\d")


def masked(line: str) -> list[str]:
    """Tokens of a line, those with a digit as a variable field."""
    tokens = line.split()
    return [FIELD if _DIGIT.search(t) else t for t in tokens] if _DIGIT.search(line) else tokens


def _hash(text: str) -> bytes:
    return hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest()


def leaf(tokens: list[str], depth: int = DEPTH) -> bytes:
    return _hash("\n".join([str(len(tokens)), *tokens[:depth]]))


def _numbers(digests: list[bytes]) -> pa.Array:
    return pa.array(np.frombuffer(b"".join(digests), "<i8"))


def _placed(depth: int):
    """Rows (key, text) -> (key, number, leaf, line, several) of lines with tokens. ``several``: the text has other lines too in the leaf."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, numbers, leaves, lines, more = [], [], [], [], []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                first, several, begin = {}, set(), len(leaves)
                for number, line in enumerate((text or "").split("\n")):
                    if tokens := masked(line):
                        at, mark = leaf(tokens, depth), _hash(" ".join(tokens))
                        if first.setdefault(at, mark) != mark:
                            several.add(at)
                        numbers.append(number)
                        leaves.append(at)
                        lines.append(mark)
                keys += [key] * (len(leaves) - begin)
                more += [at in several for at in leaves[begin:]] if several else [False] * (len(leaves) - begin)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(numbers, pa.int32()), _numbers(leaves), _numbers(lines), pa.array(more, pa.bool_())], ["key", "number", "leaf", "line", "several"])

    return run


def _told(depth: int):
    """Rows (key, text) -> the distinct (leaf, line, tokens) of a batch, tokens with a space between: none holds one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[str, bytes] = {}
            for text in batch.column(1).to_pylist():
                for line in (text or "").split("\n"):
                    if (tokens := masked(line)) and (joined := " ".join(tokens)) not in seen:
                        seen[joined] = leaf(tokens, depth)
            yield pa.RecordBatch.from_arrays([_numbers(list(seen.values())), _numbers([_hash(x) for x in seen]), pa.array(list(seen), pa.string())], ["leaf", "line", "tokens"])

    return run


def _twice(lines: DataFrame, by: list[str]) -> DataFrame:
    """(by..., twice): by how much the sum of the lines' documents is more than their distinct documents, of rows (key, by...) for a document's distinct lines."""
    n = lines.groupBy("key", *by).agg(F.count("*").alias("n")).where("n > 1")
    return n.groupBy(*by).agg(F.sum(F.col("n") - 1).alias("twice"))


def templates(keyed: DataFrame, depth: int = DEPTH, recurs: int = RECURS, constant: float = CONSTANT) -> tuple[DataFrame, DataFrame]:
    """Of rows (key, text): the lines' places (key, number, leaf, line) and the recurring templates' lines (leaf, line, template, documents).

    A document counts once for a token and for a template, however many of its lines
    have them: only documents with several lines in a leaf can be in a sum of the lines'
    documents twice, and what they add is taken off. A key has one text.
    """
    lines = saved(keyed.mapInArrow(_placed(depth), "key long, number int, leaf long, line long, several boolean"), "lines")
    once = lines.select("key", "leaf", "line").distinct()
    counted = saved(once.groupBy("leaf", "line").agg(F.count("*").alias("documents")), "line-counts")
    # A leaf with fewer documents has no template that recurs. Texts are wanted of the others alone.
    hot = saved(lines.select("key", "leaf").distinct().groupBy("leaf").agg(F.count("*").alias("n")).where(F.col("n") >= recurs).select("leaf"), "leaves")
    texts = keyed.mapInArrow(_told(depth), "leaf long, line long, tokens string").join(hot, "leaf", "left_semi")
    texts = texts.groupBy("leaf", "line").agg(F.first("tokens").alias("tokens")).join(counted, ["leaf", "line"])
    texts = saved(texts.withColumn("tokens", F.split("tokens", " ", -1)), "line-texts")
    tokens = texts.select("leaf", "line", "documents", F.posexplode("tokens").alias("place", "token"))
    repeats = saved(lines.where("several").select("key", "leaf", "line").distinct().join(texts.select("leaf", "line", "tokens"), ["leaf", "line"]), "repeats")
    support = tokens.groupBy("leaf", "place", "token").agg(F.sum("documents").alias("support")).where(F.col("support") >= recurs).where(F.col("token") != FIELD)
    place = ["leaf", "place", "token"]
    twice = saved(_twice(repeats.select("key", "leaf", F.posexplode("tokens").alias("place", "token")), place), "twice")
    support = support.join(twice, place, "left").where(F.col("support") - F.coalesce("twice", F.lit(0)) >= recurs).select(*place)
    told = tokens.join(support.withColumn("constant", F.lit(True)), ["leaf", "place", "token"], "left")
    shape = told.groupBy("leaf", "line").agg(
        F.first("documents").alias("documents"),
        F.avg(F.col("constant").isNotNull().cast("double")).alias("share"),
        F.xxhash64(F.sort_array(F.collect_list(F.when(F.col("constant"), F.struct("place", "token"))))).alias("template"),
    )
    shape = saved(shape.where(F.col("share") >= constant), "shapes")
    recurring = shape.groupBy("leaf", "template").agg(F.sum("documents").alias("total")).where(F.col("total") >= recurs)
    twice = saved(_twice(repeats.drop("tokens").join(shape, ["leaf", "line"]), ["leaf", "template"]), "twice")
    recurring = recurring.join(twice, ["leaf", "template"], "left").select("leaf", "template", (F.col("total") - F.coalesce("twice", F.lit(0))).alias("total")).where(F.col("total") >= recurs)
    return lines.drop("several"), shape.join(recurring, ["leaf", "template"]).select("leaf", "line", "template", F.col("total").alias("documents"))


def _without(text: pd.Series, numbers: pd.Series) -> pd.Series:
    out = []
    for t, drop in zip(text, numbers, strict=True):
        gone = set() if drop is None else {int(x) for x in drop}
        out.append(t if not gone else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone))
    return pd.Series(out)


def without_templates(docs: DataFrame, depth: int = DEPTH, recurs: int = RECURS, constant: float = CONSTANT) -> DataFrame:
    """Per row of ``docs``: doc_id, text without the lines of recurring templates, n_lines, n_dropped.

    Lines end at a newline; lines without tokens are kept and belong to no template.
    Documents are counted by id and text: rows that repeat both are one document and
    lose the same lines. A null text stays null with no lines. Long lines are looked at
    whole. Other columns are not read. An empty table gives no rows.
    """
    base = bounded(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))).withColumn("key", F.xxhash64("doc_id", "text"))
    lines, dropped = templates(base.select("key", "text"), depth, recurs, constant)
    gone = lines.join(dropped.select("leaf", "line").distinct(), ["leaf", "line"], "left_semi").select("key", "number").distinct().groupBy("key").agg(F.collect_list("number").alias("gone"))
    # One plan at every size: what is dropped grows with the input and is not broadcast.
    joined = base.join(saved(gone, "dropped-lines").hint("merge"), "key", "left")
    n = F.when(F.col("text").isNull(), 0).otherwise(F.regexp_count("text", F.lit("\n")) + 1)
    lost = F.coalesce(F.size("gone"), F.lit(0))
    return joined.select("doc_id", F.pandas_udf(_without, "string")("text", "gone").alias("text"), n.cast("long").alias("n_lines"), F.when(F.col("gone").isNull(), 0).otherwise(lost).cast("long").alias("n_dropped"))
