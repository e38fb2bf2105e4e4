"""Toxicity by a subsequence string-kernel support vector machine with Nyström landmarks.

Kernel. A text unit (a run of non-space characters; runs of single characters are read
as one unit too), with marks at both ends, maps to its subsequences of four characters
within a window, each
weighted by DECAY to the power of its span; so a gap or an inserted character lowers a
match and does not end it. Units are scaled by the norm that a unit of their length with
distinct subsequences would have. Case and digits that stand for letters are folded, and
other characters than letters left out.

Training. Landmarks are the pieces of units that tell toxic from other texts best, and
frequent other units. Nyström features of a unit are its kernel values at
the landmarks, times the inverse root of the landmarks' kernel matrix. A linear
support vector machine in that space is trained on labelled sentences as bags: a sentence
of a toxic text counts by its highest unit, and the units that speak for a bag are chosen
anew in each round, as are the clean units that come nearest to them. Spoken units with a
letter inserted are trained on as well. A logistic curve turns a text's three highest
margins and its number of units into a score.

Scoring. The margin of a unit is linear in its subsequence weights, so landmarks and
weights fold to one table of weights by subsequence, and a unit costs its subsequences
and not its kernel values at all landmarks. Every unit of every text is scored; workers
remember the margins of units they have seen.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from heapq import nlargest

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import bounded, saved

#: Kernel: span decay and largest span of four characters.
DECAY, WINDOW = 0.7, 7
#: Bounds of training: labelled texts of each class, characters of them, landmarks, other units;
#: characters of a unit that is trained on. Scoring has no bounds.
MOST_TEXTS, MOST_CHARS, LANDMARKS, OTHERS = 1000, 4_000_000, 160, 6_000
MOST_UNIT = 64
ROUNDS, GRAMS = 4, (5, 7, 9)
#: Parts of the sample; the score's curve is fitted on parts that a model has not seen.
FOLDS = 3
CACHE = 200_000
#: Fixed folding of characters that stand for letters.
STANDS_FOR = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}
SENTENCE = re.compile(r"(?<=[.!?])\s+|\n")
_SINGLES = re.compile(r"(?<!\S)\S(?:\s\S(?!\S)){2,}")

_ALPHABET = 45  # 0 is left out; 1-26 letters; 27-42 other letters; 43 and 44 the ends of a unit
_BITS = 20  # subsequences are numbered by a hash
_NUMBERS = 1 << _BITS
_BEGIN, _END = "\2", "\3"


def _codes() -> np.ndarray:
    table = np.zeros(0x3000, np.uint8)
    for c in range(len(table)):
        low = chr(c).lower()[0]
        if "a" <= low <= "z":
            table[c] = ord(low) - 96
        elif low.isalpha():
            table[c] = 27 + ord(low) % 16
    for c, letter in STANDS_FOR.items():
        table[ord(c)] = ord(letter) - 96
    table[ord(_BEGIN)], table[ord(_END)] = 43, 44
    return table


CODES = _codes()


def coded(units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(character codes of all units, index of the unit of each, length of each unit); other characters than letters and their stand-ins are left out."""
    units = [f"{_BEGIN}{u}{_END}" for u in units]
    chars = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = np.where(chars < len(CODES), CODES[np.minimum(chars, len(CODES) - 1)], 27 + chars % 16).astype(np.int64)
    own = np.repeat(np.arange(len(units)), np.fromiter(map(len, units), np.int64, len(units)))
    keep = codes > 0
    codes, own = codes[keep], own[keep]
    return codes, own, np.bincount(own, minlength=len(units))


def subsequences(codes: np.ndarray, own: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """(unit, subsequence number, weight) of all subsequences, one placing after another."""
    n = len(codes)
    for span in range(3, WINDOW):
        if n <= span:
            break
        whole = np.flatnonzero(own[: n - span] == own[span:])
        units, ends = own[whole], codes[whole] * _ALPHABET**3 + codes[whole + span]
        inner = [codes[whole + k] for k in range(span)]
        for second in range(1, span - 1):
            for third in range(second + 1, span):
                number = ends + (inner[second] * _ALPHABET + inner[third]) * _ALPHABET
                yield units, (number * 0x9E3779B1 >> 12) & (_NUMBERS - 1), DECAY ** (span + 1)


def norms(lengths: np.ndarray) -> np.ndarray:
    """Norm of a unit of each length, ends included, whose subsequences are all distinct; that of one subsequence at least."""
    total = np.zeros(len(lengths))
    for span in range(3, WINDOW):
        total += np.maximum(lengths - span, 0) * ((span - 1) * (span - 2) // 2) * DECAY ** (2 * (span + 1))
    return np.sqrt(np.maximum(total, DECAY**8))


def units_of(text: str) -> list[str]:
    """Units of a text: runs of non-space characters, and runs of single characters as one."""
    low = text.lower()
    units = low.split()
    if any(len(u) == 1 for u in units):
        units += ["".join(x.split()) for x in _SINGLES.findall(low)]
    return units


@dataclass
class Model:
    """Weights by subsequence, the margin's offset, and the logistic curve of the score over a text's evidence."""

    table: np.ndarray
    bias: float
    curve: np.ndarray  # weights of the evidence and, last, an offset
    floor: float  # margin where there is no unit

    def margins(self, units: list[str]) -> np.ndarray:
        codes, own, lengths = coded(units)
        total = np.zeros(len(units))
        for unit, number, weight in subsequences(codes, own):
            total += weight * np.bincount(unit, self.table[number], len(units))
        return total / norms(lengths) + self.bias

    def evidence(self, margins: list[float]) -> list[float]:
        """A text's three highest margins, and how many units it has."""
        top = nlargest(3, margins)
        return [*(max(m, self.floor) for m in top), *[self.floor] * (3 - len(top)), float(np.log1p(len(margins)))]

    def score(self, evidence: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(evidence @ self.curve[:-1] + self.curve[-1], -35, 35)))


def _flat(share: float) -> Model:
    """A model by which every text has one score."""
    return Model(np.zeros(_NUMBERS, np.float32), 0.0, np.array([0.0] * 4 + [float(np.log(share / (1 - share)))]), 0.0)


def _features(units: list[str], landmarks: list[str]) -> np.ndarray:
    """Kernel values of units at landmarks."""
    codes, own, lengths = coded(landmarks)
    found = list(subsequences(codes, own))
    used = np.unique(np.concatenate([number for _, number, _ in found]))
    place = np.full(_NUMBERS, -1, np.int32)
    place[used] = np.arange(len(used))
    wide = np.zeros((len(used), len(landmarks)), np.float32)
    for unit, number, weight in found:
        np.add.at(wide, (place[number], unit), weight)
    wide /= norms(lengths)[None, :]
    out = np.zeros((len(units), len(landmarks)))
    codes, own, lengths = coded(units)
    for unit, number, weight in subsequences(codes, own):
        at = place[number]
        hit = at >= 0
        unit, at = unit[hit], at[hit]
        if len(unit):
            heads = np.flatnonzero(np.append(True, unit[1:] != unit[:-1]))
            out[unit[heads]] += weight * np.add.reduceat(wide[at], heads, axis=0)
    return out / norms(lengths)[:, None]


def _svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = 1e-4, steps: int = 40) -> tuple[np.ndarray, float]:
    """Linear SVM of squared hinge loss, by Newton steps on the points inside the margin, halved where they overshoot."""
    x1 = np.hstack([x, np.ones((len(x), 1))])
    weight = weight / weight.sum()
    ridge = np.diag(np.append(np.full(x.shape[1], penalty), 1e-9))
    w = np.zeros(x1.shape[1])

    def loss(v):
        return float((weight * np.maximum(0, 1 - y * (x1 @ v)) ** 2).sum() + v @ ridge @ v)

    now = loss(w)
    for _ in range(steps):
        inside = 1 - y * (x1 @ w) > 0
        part = x1[inside] * weight[inside][:, None]
        step = np.linalg.solve(part.T @ x1[inside] + ridge, part.T @ y[inside]) - w
        rate = 1.0
        while (then := loss(w + rate * step)) > now and rate > 1e-4:
            rate /= 2
        w, gain, now = w + rate * step, now - then, then
        if gain < 1e-9:
            break
    return w[:-1], float(w[-1])


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights and, last, the offset of a logistic curve, targets drawn in by one text a class, by damped Newton steps."""
    positive, negative = float((y == 1).sum()), float((y == 0).sum())
    t = np.where(y == 1, (positive + 1) / (positive + 2), 1 / (negative + 2))
    design = np.hstack([x, np.ones((len(x), 1))])
    ridge = np.append(np.full(x.shape[1], 1e-4), 1e-6)
    a = np.zeros(design.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(design @ a, -35, 35)))
        h = (design * (p * (1 - p) / len(x))[:, None]).T @ design + np.diag(ridge)
        a = a + np.clip(np.linalg.solve(h, design.T @ (t - p) / len(x) - ridge * a), -4, 4)
    return a


def _grams(unit: str) -> set[str]:
    ended = f"^{unit}$"
    return {ended[i : i + n] for n in GRAMS for i in range(len(ended) - n + 1)} or {ended}


def _inserted(unit: str, rng: np.random.Generator) -> str:
    at = int(rng.integers(1, max(2, len(unit))))
    return unit[:at] + "abcdefghijklmnopqrstuvwxyz"[int(rng.integers(26))] + unit[at:]


def train(texts: list[str], labels: list[int]) -> Model:
    """Fit a model on whole texts labelled 0 or 1. With one class alone, every text has the same score.

    The score's curve is fitted on evidence of texts that the margin was not trained on:
    each of FOLDS parts of the texts is measured by a model of the others. Where a class
    has fewer texts than parts, the curve is that of the texts themselves.
    """
    y = np.array(labels)
    share = (int((y == 1).sum()) + 1) / (len(y) + 2)
    model = _margins(texts, y) if len(set(labels)) == 2 else None
    if model is None:
        return _flat(share)
    fold = np.empty(len(y), int)
    for k in (0, 1):
        fold[y == k] = np.arange(int((y == k).sum())) % FOLDS
    unseen, known = np.zeros((len(y), 4)), np.zeros(len(y), bool)
    for f in range(FOLDS):
        there, here = np.flatnonzero(fold != f), np.flatnonzero(fold == f)
        part = _margins([texts[k] for k in there], y[there]) if len(set(y[there].tolist())) == 2 else None
        if part is not None and len(here):
            unseen[here], known[here] = _evidence(part, {}, [texts[k] for k in here]), True
    if len(set(y[known].tolist())) < 2:
        unseen, known = _evidence(model, {}, texts), np.ones(len(y), bool)
    model.curve = _logistic(unseen[known], y[known])
    return model


def _margins(texts: list[str], y: np.ndarray) -> Model | None:
    """A model without its score's curve, of texts of both classes; None if nothing tells them apart."""
    labels = y.tolist()
    rng = np.random.Generator(np.random.PCG64(11))
    plain = lambda u: "".join(c for c in u if c.isalnum() or c in STANDS_FOR)
    one: dict[str, str] = {}  # a unit is held once, however many sentences have it
    bags = [[sorted({one.setdefault(v, v) for v in (plain(u) for u in units_of(s) if len(u) <= MOST_UNIT) if v}) for s in SENTENCE.split(t or "")] for t in texts]
    n = {k: int((y == k).sum()) for k in (0, 1)}
    # How often a piece of a unit is met in toxic and in other texts says where to look first.
    grams = {0: Counter(), 1: Counter()}
    units_in = {0: Counter(), 1: Counter()}
    for bag, label in zip(bags, labels, strict=True):
        seen = {u for s in bag for u in s}
        units_in[label].update(seen)
        grams[label].update({g for u in seen for g in _grams(u)})

    def evidence(g: str) -> float:
        """Log odds of a piece, none where fewer than two toxic texts have it."""
        if grams[1][g] < 2:
            return 0.0
        return float(np.log((grams[1][g] + 0.5) / (n[1] + 1)) - np.log((grams[0][g] + 0.5) / (n[0] + 1))) * float(np.log1p(grams[1][g]))

    told = {g: e for g in grams[1] if len(g) >= 3 and (e := evidence(g)) > 0}
    worth = sorted(told, key=lambda g: (-told[g], g))
    common = sorted((u for u in units_in[0] if len(u) >= 3), key=lambda u: (-units_in[0][u], u))
    bare = lambda g: g.removeprefix("^").removesuffix("$")
    landmarks = list(dict.fromkeys([bare(g) for g in worth[: LANDMARKS * 2 // 3]] + common[: LANDMARKS // 3])) or ["aaa"]
    clean = sorted(units_in[0])
    base = list(dict.fromkeys(common[: OTHERS // 3] + clean[:: max(1, len(clean) * 3 // (2 * OTHERS))]))
    toxic = [(k, s) for k in np.flatnonzero(y == 1) for s in range(len(bags[k])) if bags[k][s]]
    first = {u: max((told.get(g, 0.0) for g in _grams(u)), default=0.0) for u in units_in[1]}

    kernel = _features(landmarks, landmarks)
    values, vectors = np.linalg.eigh((kernel + kernel.T) / 2)
    kept = values > 1e-6 * values.max()
    root = vectors[:, kept] / np.sqrt(values[kept])
    known: dict[str, np.ndarray] = {}

    def phi(units: list[str]) -> np.ndarray:
        new = [u for u in dict.fromkeys(units) if u not in known]
        if new:
            known.update(zip(new, _features(new, landmarks) @ root, strict=True))
        return np.array([known[u] for u in units])

    codes, own, lengths = coded(landmarks)
    margin, model = first, None
    for turn in range(ROUNDS):
        # Each toxic text speaks through its sentences' highest units, as far as they come near its highest one.
        witness, by_text = Counter(), {}
        for k, s in toxic:
            best = max(bags[k][s], key=lambda u: (margin.get(u, 0.0), u))
            by_text.setdefault(k, []).append((margin.get(best, 0.0), best))
        for found in by_text.values():
            top = max(found)[0]
            if top > 0:
                witness.update({u for m, u in found if m >= 0.6 * top})
        spoken = [u for u in sorted(witness) if units_in[0][u] * n[1] < 0.2 * units_in[1][u] * n[0]]
        if not spoken:
            break
        varied = [_inserted(u, rng) for u in spoken]
        x = np.vstack([phi(spoken), phi(varied), phi(base)])
        t = np.append(np.ones(2 * len(spoken)), -np.ones(len(base)))
        w_toxic = np.array([1.0 + np.log1p(witness[u]) for u in spoken])
        w = np.concatenate([w_toxic, 0.5 * w_toxic, np.array([units_in[0][u] ** 0.75 for u in base])])
        w[: 2 * len(spoken)] *= 0.5 * w[2 * len(spoken) :].sum() / w[: 2 * len(spoken)].sum()
        coefficient, bias = _svm(x, t, w)
        # margin(u) = k(u, landmarks) @ beta + bias, and k is linear in u's subsequences.
        table = np.zeros(_NUMBERS)
        scaled = root @ coefficient / norms(lengths)
        for unit, number, weight in subsequences(codes, own):
            np.add.at(table, number, weight * scaled[unit])
        model = Model(table.astype(np.float32), bias, np.array([1.0, 0, 0, 0, 0]), bias)
        mine = sorted(units_in[1])
        margin = {u: m + 1 for u, m in zip(mine, model.margins(mine).tolist(), strict=True) if first[u] > 0 or m > 0}
        # The clean units that come nearest the other side are held against it in the next round.
        hard = model.margins(clean)
        worst = np.argsort(-hard)[: OTHERS // 4]
        base = list(dict.fromkeys(base + [clean[i] for i in worst if hard[i] > -0.9]))
    return model


def _evidence(model: Model, known: dict[str, float], texts: list[str | None]) -> np.ndarray:
    """Each text's evidence; ``known`` remembers the margins of units."""
    top = []
    for a in range(0, len(texts), 64):
        units = [units_of(t or "") for t in texts[a : a + 64]]
        if len(known) > CACHE:
            known.clear()
        new = list({u for us in units for u in us if u not in known})
        for i in range(0, len(new), 8192):
            part = new[i : i + 8192]
            known.update(zip(part, model.margins(part).tolist(), strict=True))
        top += [model.evidence(list(map(known.__getitem__, us))) for us in units]
    return np.array(top, float).reshape(-1, 4)


def _scored(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, float] = {}
        for batch in batches:
            top = _evidence(model, known, batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(top), pa.float64())], ["doc_id", "score"])

    return run


def held_out(doc_id) -> F.Column:
    """Rows whose labels are never learnt from: crc32 of the id as text is a multiple of five."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def _within(rows):
    """Rows in order, without those that take their class over MOST_CHARS: all that ``_fitting`` may want."""
    chars = {0: 0, 1: 0}
    for r in rows:
        if chars[r["toxic"]] + len(r["text"]) <= MOST_CHARS:
            chars[r["toxic"]] += len(r["text"])
            yield r


def _fitting(rows: list[tuple[str, int]]) -> list[tuple[str, int]]:
    """Rows (text, class) in order, as many as fit: each class has half of MOST_CHARS and what the other leaves."""
    chars = [sum(len(t) for t, y in rows if y == k) for k in (0, 1)]
    room = [max(MOST_CHARS // 2, MOST_CHARS - chars[1 - k]) for k in (0, 1)]
    out = []
    for text, y in rows:
        if len(text) <= room[y]:
            room[y] -= len(text)
            out.append((text, y))
    return out


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Train on a bounded sample of labelled texts: at most MOST_TEXTS of each class, in order of a hash of the id, and MOST_CHARS in all: half for each class, and what one class leaves for the other. A text that does not fit is skipped; later ones still count.

    Rows of the held-out fold, null ids and null labels are not used. An id with labels
    of both classes is toxic; of differing texts of one id the one of smallest hash counts,
    so no id takes more than its place. Parts of a text of more than MOST_UNIT characters
    without a space are not learnt from.
    """
    pool = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where("doc_id IS NOT NULL AND toxic IN (0, 1)").where(~held_out(F.col("doc_id")))
    pool = pool.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = (F.xxhash64("doc_id", F.lit(5)), "doc_id")
    chosen = saved(pool.where("toxic = 1").orderBy(*order).limit(MOST_TEXTS).unionByName(pool.where("toxic = 0").orderBy(*order).limit(MOST_TEXTS)), "toxic-sample")
    # The sample is at most 2 x MOST_TEXTS ids, so it may be broadcast.
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
    texts = texts.where(F.length("text") <= MOST_CHARS // 2).groupBy("doc_id", "toxic").agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("least"))
    texts = texts.select("doc_id", "toxic", "least.text").orderBy(*order)
    rows = _fitting([(r["text"], r["toxic"]) for r in _within(texts.limit(2 * MOST_TEXTS).select("toxic", "text").toLocalIterator())])
    return train([t for t, _ in rows], [k for _, k in rows])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Per document: doc_id, held_out, score (0 to 1), predicted (1 if score >= 0.5).

    Only the text decides a score. Null or empty texts have the score of a text in which
    nothing speaks for toxicity; every unit of a long text counts. Repeated rows are each
    returned; a null id is held out of no fold (false). An empty table gives no rows.
    """
    base = bounded(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")))
    scored = base.mapInArrow(_scored(model), "doc_id long, score double")
    return scored.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def accepted(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs``, all columns, whose score is under 0.5; decided row by row."""
    known: dict[str, float] = {}

    def clean(text: pd.Series) -> pd.Series:
        return pd.Series(model.score(_evidence(model, known, list(text))) < 0.5, dtype=bool)

    return bounded(docs).where(F.pandas_udf(clean, "boolean")(F.col("text").cast("string")))
