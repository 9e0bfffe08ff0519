"""Toxicity by a linear classifier over character n-grams.

Features are the presence of n-grams, scaled by their naive Bayes log-count
ratios between toxic and other texts; weights come from logistic regression on
the scaled features.  Fitting takes a bounded sample of labelled texts and
keeps a bounded number of n-grams; scoring reads every whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadrille.llm._bytes import ASCII_LOWER, PAD, Texts, eights, texts
from quadrille.llm._sampling import LONGEST_SAMPLED, sample_by
from quadrille.llm._store import Scratch, lean

SIZES = (4, 5, 6)
#: Bounds of the fitting sample, for each label, and of the model.
SAMPLE_ROWS, SAMPLE_BYTES, FEATURES = 2500, 8 << 20, 1024
#: Characters of a text over LONGEST_SAMPLED bytes that are learned from.
LONG_PIECE = 1 << 16
_BUCKETS = 20
_KEY = np.uint64(0x9E3779B97F4A7C15)

#: A-Z in lower case and every white space as one kind.
TABLE = ASCII_LOWER.copy()
TABLE[[0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = 0x20


class Model(NamedTuple):
    #: Packed n-grams, sorted, with their weights (ratio times coefficient).
    keys: np.ndarray
    weights: np.ndarray
    bias: float
    maybe: np.ndarray


def _bucket(keys: np.ndarray, bits: int) -> np.ndarray:
    return ((keys * _KEY) >> np.uint64(64 - bits)).astype(np.int64)


def _grams(t: Texts, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(packed n-grams that lie in one text, their places); the top byte holds the n-gram's size."""
    n = len(t.data) - PAD
    keys = eights(t.data)[:n] & np.uint64((1 << (8 * size)) - 1)
    ok = np.ones(n, bool)
    for back in range(1, size):
        at = t.offsets[1:] - back
        ok[at[at >= t.offsets[:-1]]] = False
    places = np.flatnonzero(ok)
    return keys[places] | np.uint64(size << 56), places


def _sets(held: pa.Array, pick) -> Iterator[tuple[int, np.ndarray]]:
    """(text, its distinct n-grams that ``pick`` lets through)."""
    for t in texts(held, 1 << 17, TABLE):
        found = []
        for size in SIZES:
            keys, places = _grams(t, size)
            ok = pick(keys)
            found.append((keys[ok], np.searchsorted(t.offsets, places[ok], "right") - 1))
        keys, of = np.concatenate([k for k, _ in found]), np.concatenate([d for _, d in found])
        by = np.argsort(of, kind="stable")
        for d, part in enumerate(np.split(keys[by], np.searchsorted(of[by], np.arange(1, len(t.offsets) - 1)))):
            yield t.first + d, np.unique(part)


def _logistic(x: np.ndarray, labels: np.ndarray, weight: np.ndarray, ridge: float, bias: float) -> np.ndarray:
    """Ridge logistic regression by Newton steps, halved until the loss falls; the last column is the bias."""
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    sign = 1 - 2 * labels

    def loss(b: np.ndarray) -> float:
        return float(weight @ np.logaddexp(0, sign * (x @ b.astype(np.float32))) + penalty @ (b * b) / 2)

    beta = np.zeros(x.shape[1])
    beta[-1] = bias
    now = loss(beta)
    for _ in range(40):
        mu = 1 / (1 + np.exp(-np.clip((x @ beta.astype(np.float32)).astype(float), -500, 500)))
        slope = x.T @ (weight * (mu - labels)).astype(np.float32) + penalty * beta
        curve = (x * (weight * mu * (1 - mu)).astype(np.float32)[:, None]).T @ x
        move, step = np.linalg.solve(curve + np.diag(penalty), slope), 1.0
        while (after := loss(beta - step * move)) > now and step > 1e-6:
            step /= 2
        if now - after < 1e-7 * abs(now):
            break
        beta, now = beta - step * move, after
    return beta


def fit(held: pa.Array, labels: np.ndarray, weight: np.ndarray, features: int = FEATURES, ridge: float = 2.0) -> Model:
    """Model of sample texts with labels 0 and 1; ``weight`` undoes unequal sampling."""
    weight = weight / weight.mean() if len(weight) else weight
    ones = float(weight[labels == 1].sum())
    zeros = float(weight[labels == 0].sum())
    none = Model(np.zeros(0, np.uint64), np.zeros(0), float(np.log((ones + 0.5) / (zeros + 0.5))), np.zeros(1 << 20, bool))
    if not ones or not zeros:
        return none
    seen = np.zeros((2, 1 << _BUCKETS))
    rows = np.zeros(1 << _BUCKETS, np.int32)
    everything = lambda keys: np.ones(len(keys), bool)
    for d, keys in _sets(held, everything):
        at = np.unique(_bucket(keys, _BUCKETS))
        seen[labels[d], at] += weight[d]
        rows[at] += 1
    share1, share0 = seen[1] / ones, seen[0] / zeros
    n1, n0 = float((labels == 1).sum()), float((labels == 0).sum())
    pool = (seen.sum(0) + 0.5) / (ones + zeros + 1)
    z = (share1 - share0) / np.sqrt(pool * (1 - np.minimum(pool, 0.999)) * (1 / n1 + 1 / n0))
    z[rows < 3] = 0
    top = np.argsort(-np.abs(z), kind="stable")[:features]
    top = top[np.abs(z[top]) >= 2.5]
    wanted = np.zeros(1 << _BUCKETS, bool)
    wanted[top] = True

    pairs = [(d, keys) for d, keys in _sets(held, lambda keys: wanted[_bucket(keys, _BUCKETS)]) if len(keys)]
    if not pairs:
        return none
    of = np.concatenate([np.full(len(k), d) for d, k in pairs])
    keys, column = np.unique(np.concatenate([k for _, k in pairs]), return_inverse=True)
    if len(keys) > features:
        keep = np.sort(np.argsort(-np.abs(z[_bucket(keys, _BUCKETS)]), kind="stable")[:features])
        place = np.full(len(keys), -1)
        place[keep] = np.arange(len(keep))
        ok = place[column] >= 0
        keys, column, of = keys[keep], place[column[ok]], of[ok]
    x = np.zeros((len(held), len(keys) + 1), np.float32)
    x[of, column] = 1
    p, q = (1 + np.where(labels == k, weight, 0).astype(np.float32) @ x for k in (1, 0))
    p, q = p[:-1], q[:-1]
    ratio = np.log((p / (ones + 2)) / (q / (zeros + 2)))
    x[:, :-1] *= ratio.astype(np.float32)
    x[:, -1] = 1
    beta = _logistic(x, labels, weight, ridge, none.bias)
    maybe = np.zeros(1 << 20, bool)
    maybe[_bucket(keys, 20)] = True
    return Model(keys, beta[:-1] * ratio, float(beta[-1]), maybe)


def scores(column: pa.Array, model: Model) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, probabilities that the texts are toxic)."""
    for t in texts(column, 2 << 20, TABLE):
        rows, hits = len(t.offsets) - 1, [np.zeros(0, np.int64)]
        for size in SIZES if len(model.keys) else ():
            keys, places = _grams(t, size)
            at = np.flatnonzero(model.maybe[_bucket(keys, 20)])
            found = np.minimum(np.searchsorted(model.keys, keys[at]), len(model.keys) - 1)
            same = model.keys[found] == keys[at]
            of = np.searchsorted(t.offsets, places[at[same]], "right") - 1
            hits.append(of * len(model.keys) + found[same])
        pairs = np.unique(np.concatenate(hits))
        width = max(1, len(model.keys))
        sums = np.bincount(pairs // width, model.weights[pairs % width], rows) if len(pairs) else np.zeros(rows)
        yield t.first, 1 / (1 + np.exp(-np.clip(sums + model.bias, -500, 500)))


def score_toxicity(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, score, predicted.

    Null and empty texts get the score of a text without any known n-gram; texts
    of any length are scored whole; a score of exactly 0.5 predicts 1.  Other
    columns are ignored, null ids come back null, repeated rows each get a row; an empty table
    gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in lean(batches):
            for first, found in scores(batch.column(1), shared.value):
                ids = batch.column(0).slice(first, len(found))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(found), pa.array((found >= 0.5).astype(np.int32))], ["doc_id", "score", "predicted"]
                )

    given = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = given.schema["doc_id"].dataType.simpleString()
    return given.mapInArrow(score, f"doc_id {kind}, score double, predicted int")


def drop_toxic(docs: DataFrame, model: Model, *, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score under 0.5, with all their columns; cases as in :func:`score_toxicity`."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text_col)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in lean(batches):
            parts = [found < 0.5 for _, found in scores(batch.column(place), shared.value)]
            if parts:
                yield batch.filter(pa.array(np.concatenate(parts)))

    return docs.mapInArrow(keep, docs.schema)


def fit_on(docs: DataFrame, labels: DataFrame, *, rows: int = SAMPLE_ROWS, size: int = SAMPLE_BYTES) -> Model:
    """Fits on a bounded sample of ``docs`` (doc_id, text) that ``labels`` (doc_id, toxic) covers.

    For each label at most ``rows`` texts and ``size`` bytes are expected, by
    the hash of the id.  Null labels are left out; of several labels for one id
    the greatest holds.  Of texts over LONGEST_SAMPLED bytes the middle LONG_PIECE
    characters are learned from.  Without both labels in the sample, the model is
    the prior alone.
    """
    marks = labels.where(F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    totals = {r["toxic"]: r["n"] for r in marks.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    share = F.coalesce(*[F.when(F.col("toxic") == k, F.lit(int(min(1.0, rows / n) * 2**31))) for k, n in totals.items()], F.lit(0))
    # About ``rows`` ids for each label: a broadcast of fixed size.
    marks = marks.where(F.pmod(F.xxhash64("doc_id", F.lit(29)), F.lit(2**31)) < share)
    middle = F.substring("text", F.greatest(F.lit(1), F.floor((F.char_length("text") - LONG_PIECE) / 2).cast("int")), F.lit(LONG_PIECE))
    known = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(marks), "doc_id")
    known = known.withColumn("text", F.when(F.octet_length("text") > LONGEST_SAMPLED, middle).otherwise(F.col("text")))
    known = Scratch(docs.sparkSession, "toxicity").save(known, "sample")
    sample, _ = sample_by(known, "toxic", rows, size)
    picked = sample.select(F.xxhash64("doc_id", F.lit(17)).alias("h"), "text", "toxic").toArrow()
    picked = picked.sort_by([("h", "ascending"), ("text", "ascending")]).combine_chunks()
    marked = picked["toxic"].to_numpy().astype(np.int64)
    got = {k: max(1, int((marked == k).sum())) for k in (0, 1)}
    weight = np.array([totals[k] / got[k] for k in marked.tolist()])
    return fit(picked["text"], marked, weight)
