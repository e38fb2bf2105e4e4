"""Quality by co-training of two views.

One classifier sees a document's text, the other its metadata (language, source, length
as stored). Each is trained on the labelled sample; then, for some rounds, each labels
the unlabelled documents that it is surest of, and hands them to the other as examples.
At the end each view is calibrated on labelled documents that neither was trained on,
and a logistic combination of the two calibrated views scores every document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import bounded, saved, text_slices
from .shingles import word_hashes, word_spans

#: Bounds of training: labelled and unlabelled documents, and characters that either sample may have.
LABELLED, UNLABELLED, MOST_CHARS = 3000, 2000, 12_000_000
ROUNDS, HANDED = 3, 200
_BINS, _STATS, _META = 512, 14, 64


def text_features(column: pa.Array) -> np.ndarray:
    """Per text: shares of hashed words, and measures of its characters, words and lines. Null counts as empty."""
    out = np.zeros((len(column), _BINS + _STATS))
    for first, data, offsets in text_slices(column):
        n = len(offsets) - 1
        starts, ends, owner = word_spans(data, offsets)
        hashes = word_hashes(data, starts, ends)
        words = np.maximum(np.bincount(owner, minlength=n), 1)
        size = np.maximum(np.diff(offsets), 1)
        bins = np.bincount(owner * _BINS + (hashes >> np.uint64(40)).astype(np.int64) % _BINS, minlength=n * _BINS).reshape(n, _BINS)
        rows = out[first : first + n]
        rows[:, :_BINS] = np.sqrt(bins / words[:, None])

        doc = np.repeat(np.arange(n), np.diff(offsets))
        share = lambda mask: np.bincount(doc, mask, n) / size
        kinds = [(data >= 65) & (data <= 90), (data >= 48) & (data <= 57), data == 10, data == 124, np.isin(data, np.frombuffer(b"!?", np.uint8)), np.isin(data, np.frombuffer(b"%$&#*@=_~^+<>{}[]\\/", np.uint8)), np.isin(data, np.frombuffer(b".,;:", np.uint8)), data == 32]
        for k, mask in enumerate(kinds):
            rows[:, _BINS + k] = np.minimum(1.0, 4 * share(mask))
        lengths = ends - starts
        mean = np.bincount(owner, lengths, n) / words
        rows[:, _BINS + 8] = np.minimum(mean, 30) / 10
        rows[:, _BINS + 9] = np.sqrt(np.minimum(np.maximum(np.bincount(owner, lengths.astype(float) ** 2, n) / words - mean**2, 0), 100)) / 10
        pairs = np.unique(np.stack([owner.astype(np.uint64), hashes]), axis=1)[0].astype(np.int64) if len(hashes) else np.zeros(0, np.int64)
        rows[:, _BINS + 10] = np.bincount(pairs, minlength=n) / words
        same = np.zeros(len(hashes))
        same[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
        rows[:, _BINS + 11] = np.bincount(owner, same, n) / words
        rows[:, _BINS + 12] = np.log1p(words) / 10
        rows[:, _BINS + 13] = words <= 1
    return out


def metadata_features(lang: list, source: list, n_chars: list) -> np.ndarray:
    """Hashed language, source and their pair, and the stored length; nulls are values of their own."""
    import zlib

    out = np.zeros((len(lang), _META + 3))
    for k, (a, b, n) in enumerate(zip(lang, source, n_chars, strict=True)):
        for part in (f"l={a}", f"s={b}", f"ls={a}/{b}"):
            out[k, zlib.crc32(part.encode()) % _META] += 1
        out[k, _META:] = (n is None, np.log1p(max(n or 0, 0)) / 10, (np.log1p(max(n or 0, 0)) / 10) ** 2)
    return out


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float, steps: int = 25) -> np.ndarray:
    """Coefficients and, last, the intercept of a ridge-penalised logistic regression, by Newton steps."""
    x1 = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x1.shape[1])
    ridge = np.append(np.full(x.shape[1], penalty), 1e-6)
    weight = weight / weight.sum()
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x1 @ w, -30, 30)))
        grad = x1.T @ (weight * (p - y)) + ridge * w
        hessian = (x1 * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x1 + np.diag(ridge)
        step = np.linalg.solve(hessian, grad)
        w -= step * min(1.0, 5 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-6:
            break
    return w


def _margin(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return np.clip(x @ w[:-1] + w[-1], -30, 30)


@dataclass
class Model:
    text: np.ndarray
    metadata: np.ndarray
    text_curve: np.ndarray  # slope and offset that calibrate a view's margin
    metadata_curve: np.ndarray
    joint: np.ndarray  # weights of both calibrated margins, intercept

    def score(self, text_x: np.ndarray, metadata_x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(combined, text's, metadata's) probabilities of good quality."""
        a = _margin(text_x, self.text) * self.text_curve[0] + self.text_curve[1]
        b = _margin(metadata_x, self.metadata) * self.metadata_curve[0] + self.metadata_curve[1]
        both = np.clip(self.joint[0] * a + self.joint[1] * b + self.joint[2], -30, 30)
        return tuple(1 / (1 + np.exp(-np.clip(z, -30, 30))) for z in (both, a, b))


def co_train(text_x: np.ndarray, metadata_x: np.ndarray, labels: np.ndarray) -> Model:
    """Train both views. ``labels``: 0, 1, or -1 for unlabelled. One class alone gives its smoothed share as every score."""
    known = np.flatnonzero(labels >= 0)
    if len(set(labels[known])) < 2:
        share = ((labels[known] == 1).sum() + 1) / (len(known) + 2)
        flat = np.array([0.0, float(np.log(share / (1 - share)))])
        return Model(np.zeros(text_x.shape[1] + 1), np.zeros(metadata_x.shape[1] + 1), flat, flat, np.array([1.0, 0.0, 0.0]))
    kept_back = known[np.arange(len(known)) % 4 == 3]
    start = np.setdiff1d(known, kept_back)
    pool = np.flatnonzero(labels < 0)
    views = (text_x, metadata_x)
    given: list[dict[int, int]] = [{}, {}]
    penalties = (1e-5, 1e-3)

    def fitted(v: int) -> np.ndarray:
        extra = np.array(sorted(given[v]), dtype=int)
        rows = np.append(start, extra)
        y = np.append(labels[start], [given[v][int(i)] for i in extra]).astype(float)
        # A pseudo-label weighs half a label, and each class as often as it is labelled.
        weight = np.append(np.ones(len(start)), np.full(len(extra), 0.5))
        return _logistic(views[v][rows], y, weight, penalties[v])

    models = [fitted(0), fitted(1)]
    share = labels[start].mean()
    for _ in range(ROUNDS):
        for v, other in ((0, 1), (1, 0)):
            left = np.array([i for i in pool if int(i) not in given[other]], dtype=int)
            if not len(left):
                continue
            p = 1 / (1 + np.exp(-_margin(views[v][left], models[v])))
            good, bad = max(1, round(HANDED * share)), max(1, round(HANDED * (1 - share)))
            sure = {int(left[k]): 1 for k in np.argsort(-p, kind="stable")[:good] if p[k] > 0.9}
            sure |= {int(left[k]): 0 for k in np.argsort(p, kind="stable")[:bad] if p[k] < 0.1}
            given[other].update(sure)
        models = [fitted(0), fitted(1)]

    back = kept_back if len(set(labels[kept_back])) == 2 else known
    y = labels[back].astype(float)
    curves, logits = [], []
    for v in (0, 1):
        m = _margin(views[v][back], models[v])[:, None]
        curves.append(_logistic(m, y, np.ones(len(y)), 1e-3))
        logits.append(m[:, 0] * curves[v][0] + curves[v][1])
    return Model(models[0], models[1], curves[0], curves[1], _logistic(np.stack(logits, axis=1), y, np.ones(len(y)), 1e-3))


def held_out(doc_id) -> F.Column:
    """Documents whose labels are never learnt from: crc32 of the id as text is a multiple of five."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def _columns(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"), F.col("n_chars").cast("long").alias("n_chars"))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Train on bounded samples, drawn by a hash of the id: LABELLED labelled and UNLABELLED other documents, up to MOST_CHARS characters each.

    The others are drawn from all documents without a label. Where there is none, no
    label is handed on, and each view learns from the labels alone. Labels of the held-out
    fold are never read. Ties of the hash go by id; an id with labels of both classes is
    poor, and of rows that share an id the one of smallest hash counts. Of equally sure
    documents a view labels those first that come first in that order.
    """
    order = (F.xxhash64("doc_id", F.lit(3)), "doc_id")
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).where("doc_id IS NOT NULL AND quality IN (0, 1)").where(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.min("quality").alias("quality")).orderBy(*order).limit(LABELLED)
    known = saved(known, "quality-sample")
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id IS NOT NULL").distinct()
    others = saved(ids.join(labels.select(F.col("doc_id").cast("long").alias("doc_id")), "doc_id", "left_anti").orderBy(*order).limit(UNLABELLED).withColumn("quality", F.lit(-1)), "quality-others")
    # At most LABELLED + UNLABELLED ids are broadcast.
    rows = _columns(docs).join(F.broadcast(known.unionByName(others)), "doc_id")
    row = F.struct("text", "lang", "source", "n_chars")
    rows = rows.groupBy("doc_id", "quality").agg(F.min(F.struct(F.xxhash64(row).alias("hash"), row.alias("row"))).alias("least"))
    rows = rows.select("doc_id", "quality", "least.row.*").orderBy(*order)
    features, meta, y, chars = [], [], [], {True: 0, False: 0}
    for r in rows.toLocalIterator():
        which = r["quality"] >= 0
        if chars[which] and chars[which] + len(r["text"] or "") > MOST_CHARS:
            continue
        chars[which] += len(r["text"] or "")
        features.append(text_features(pa.array([r["text"]], pa.string()))[0])
        meta.append(metadata_features([r["lang"]], [r["source"]], [r["n_chars"]])[0])
        y.append(r["quality"])
    return co_train(np.array(features).reshape(len(y), -1) if y else np.zeros((0, _BINS + _STATS)), np.array(meta).reshape(len(y), -1) if y else np.zeros((0, _META + 3)), np.array(y, dtype=int))


def _scored(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = text_features(batch.column(1))
            m = metadata_features(*(batch.column(k).to_pylist() for k in (2, 3, 4)))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(s) for s in model.score(x, m))], ["doc_id", "score", "text_score", "metadata_score"])

    return run


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Per document: doc_id, held_out, score, text_score, metadata_score, kept (score >= 0.5).

    Whole texts are read. Null texts count as empty, nulls in metadata are values of
    their own; repeated rows are each returned. Other columns are not read. An empty
    table gives no rows.
    """
    scored = _columns(bounded(docs)).mapInArrow(_scored(model), "doc_id long, score double, text_score double, metadata_score double")
    return scored.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", "text_score", "metadata_score", (F.col("score") >= 0.5).alias("kept"))
