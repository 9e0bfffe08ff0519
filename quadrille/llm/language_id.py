"""Language identification by prediction by partial matching.

Every language has a context tree over bytes of orders 3 to 0, with escapes by
method C and exclusions, and the uniform order below.  The trees are counted
once on a bounded sample and then frozen, so the exact code length of a byte
depends on the three bytes before it alone.  All of these lengths are tabled:
contexts that some language has seen at order 3 have rows of their own, the
others share the row of their two last bytes.  Scoring a text is then two table
lookups per byte for all languages of a table together, and a sum; the language
with the shortest code wins.

A language's code lengths don't depend on the others, so languages are fitted
and scored a few at a time: one table holds TOGETHER of them at most, and driver
and workers hold one table at a time, however many languages there are.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadrille.llm._bytes import PAD, Texts, texts
from quadrille.llm._sampling import LONGEST_SAMPLED, sample_by
from quadrille.llm._store import in_turn, lean

ORDER = 3
#: Bounds of the fitting sample, for each language.
SAMPLE_ROWS, SAMPLE_BYTES = 600, 3 << 20
#: Long texts that lend a piece each where a language has no others.
LONG_TEXTS = 6
#: Languages in one table.
TOGETHER = 8
_BLOCK = 1 << 19


class Model(NamedTuple):
    langs: list[str]
    #: Byte -> code; 0 pads the start of a text, 1 is any byte that the sample lacks.
    code: np.ndarray
    size: int
    #: Three codes -> row of ``bits``; rows hold, for every next code, the bits in each language.
    state: np.ndarray
    bits: np.ndarray


def _coded(t: Texts, code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes with ORDER pads before each text, places of the texts' bytes there, text of each byte)."""
    size = len(t.data) - PAD
    of = np.repeat(np.arange(len(t.offsets) - 1), np.diff(t.offsets))
    place = np.arange(size) + ORDER * (of + 1)
    out = np.zeros(size + ORDER * (len(t.offsets) - 1), np.int32)
    out[place] = code[t.data[:size]]
    return out, place, of


def _contexts(codes: np.ndarray, place: np.ndarray, size: int) -> np.ndarray:
    return (codes[place - 3] * size + codes[place - 2]) * size + codes[place - 1]


def _blend(levels: list[np.ndarray]) -> np.ndarray:
    """Counts by order, highest first -> bits of each code."""
    rows, size = levels[0].shape
    p, escape = np.zeros((rows, size)), np.ones(rows)
    gone = np.zeros((rows, size), bool)
    for counts in levels:
        c = np.where(gone, 0, counts)
        n, kinds = c.sum(1), (c > 0).sum(1)
        live = n > 0
        weight = np.where(live, escape / np.maximum(1, n + kinds), 0)
        p += c * weight[:, None]
        escape = np.where(live, weight * kinds, escape)
        gone |= c > 0
    rest = escape / np.maximum(1, 256 - gone.sum(1))
    return -np.log2(np.where(gone, p, np.maximum(rest, 1e-30)[:, None]))


def fit(samples: dict[str, list[str]]) -> Model:
    """Frozen code lengths of the languages' sample texts."""
    langs = sorted(samples)
    parts = {k: list(texts(pa.array(v, pa.string()))) for k, v in samples.items()}
    seen = np.zeros(256, bool)
    for t in (t for ts in parts.values() for t in ts):
        seen[t.data[: len(t.data) - PAD]] = True
    code = np.ones(256, np.int32)
    code[seen] = 2 + np.arange(int(seen.sum()))
    size = 2 + int(seen.sum())

    counted = {}
    for lang in langs:
        grams = [np.zeros(0, np.int64)]
        for t in parts[lang]:
            codes, place, _ = _coded(t, code)
            grams.append(_contexts(codes.astype(np.int64), place, size) * size + codes[place])
        counted[lang] = np.unique(np.concatenate(grams), return_counts=True)
    known = np.unique(np.concatenate([np.zeros(0, np.int64), *[g // size for g, _ in counted.values()]]))
    state = len(known) + np.arange(size**3, dtype=np.int32) % size**2
    state[known] = np.arange(len(known), dtype=np.int32)

    bits = np.zeros((len(known) + size**2, size, len(langs)), np.float32)
    for at, lang in enumerate(langs):
        grams, n = counted[lang]
        third = np.zeros((len(known), size), np.int32)
        third[np.searchsorted(known, grams // size), grams % size] = n
        second = np.bincount(grams % size**3, n, size**3).astype(np.int64).reshape(size**2, size)
        first = second.reshape(size, size, size).sum(0)
        zero = first.sum(0)
        pairs = np.arange(size**2)
        for a in range(0, len(known), 4096):
            k = known[a : a + 4096]
            pair = k % size**2
            none = np.broadcast_to(zero, (len(k), size))
            bits[a : a + len(k), :, at] = _blend([third[a : a + len(k)], second[pair], first[pair % size], none])
        for a in range(0, size**2, 4096):
            pair = pairs[a : a + 4096]
            none = np.broadcast_to(zero, (len(pair), size))
            bits[len(known) + a : len(known) + a + len(pair), :, at] = _blend([second[pair], first[pair % size], none])
    return Model(langs, code, size, state, bits.reshape(len(bits) * size, len(langs)))


def code_lengths(column: pa.Array, model: Model) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, bits of each text in each language)."""
    for t in texts(column, 1 << 20):
        codes, place, of = _coded(t, model.code)
        rows = len(t.offsets) - 1
        total = np.zeros((rows, len(model.langs)))
        for a in range(0, len(place), _BLOCK):
            p, d = place[a : a + _BLOCK], of[a : a + _BLOCK]
            at = model.state[_contexts(codes, p, model.size)] * model.size + codes[p]
            found = model.bits[at]
            for k in range(len(model.langs)):
                total[d[0] : d[-1] + 1, k] += np.bincount(d - d[0], found[:, k])
        yield t.first, total


def identify(docs: DataFrame, models: Model | Iterable[Model], *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, lang_pred, score, bits_per_byte.

    ``models`` hold different languages.  ``score`` is the winner's share of 2 to
    the minus code length.  A text that is null or has no letter is ``und`` with
    score 0, and so is every text if there is no language.  Ties go to the
    language first in code-point order.  Texts of any length are scored whole,
    in blocks.  Other columns are ignored; repeated rows each get a row; an
    empty table gives an empty result.
    """
    spark = docs.sparkSession
    shared, langs = [], []
    for model in [models] if isinstance(models, Model) else models:
        shared.append(spark.sparkContext.broadcast(model))
        langs += model.langs
    names = np.array([*langs, "und"], object)
    by_name = np.argsort(np.array(langs, object), kind="stable") if langs else np.zeros(0, int)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in lean(batches):
            lettered = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
            sizes = batch.column(3).to_numpy()
            bits = np.zeros((batch.num_rows, len(langs)))
            at = 0
            for m in in_turn(shared):
                for first, found in code_lengths(batch.column(1), m):
                    bits[first : first + len(found), at : at + len(m.langs)] = found
                at += len(m.langs)
            known = lettered & bool(langs)
            if langs:
                best = by_name[bits[:, by_name].argmin(1)]
                least = bits.min(1)
                share = 1 / np.exp2(np.maximum(least[:, None] - bits, -1000)).sum(1)
            else:
                best, least, share = np.zeros(len(bits), int), np.zeros(len(bits)), np.zeros(len(bits))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(names[np.where(known, best, len(langs))], pa.string()),
                    pa.array(np.where(known, share, 0.0)),
                    pa.array(least / np.maximum(1, sizes)),
                ],
                ["doc_id", "lang_pred", "score", "bits_per_byte"],
            )

    given = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(text_col).alias("text"),
        F.coalesce(F.regexp_like(F.col(text_col), F.lit(r"\p{L}")), F.lit(False)).alias("lettered"),
        F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)).alias("size"),
    )
    kind = given.schema["doc_id"].dataType.simpleString()
    return given.mapInArrow(score, f"doc_id {kind}, lang_pred string, score double, bits_per_byte double")


def fit_on(docs: DataFrame, *, rows: int = SAMPLE_ROWS, size: int = SAMPLE_BYTES, together: int = TOGETHER) -> Iterator[Model]:
    """Models of at most ``together`` languages each, fitted on a bounded sample of ``docs`` (doc_id, text, lang), by the hash of the id.

    At most ``rows`` texts and ``size`` bytes are expected for each non-null
    language; every language is learned, from one text if need be, and where all
    its texts have over LONGEST_SAMPLED bytes from the middles of LONG_TEXTS.
    The driver holds the names of all languages, and the sample of those that
    are fitted together.
    """
    named = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "lang")
    sample, totals = sample_by(named, "lang", rows, size)
    every = sorted(r["lang"] for r in named.where("lang is not null").select("lang").distinct().collect())
    # A character has four bytes at most.
    piece = max(1, size // (4 * LONG_TEXTS))
    middle = F.substring("text", F.greatest(F.lit(1), F.floor((F.char_length("text") - piece) / 2).cast("int")), F.lit(piece))
    for first in range(0, len(every), together):
        some = every[first : first + together]
        picked = sample.where(F.col("lang").isin(some)).select(F.xxhash64("doc_id", F.lit(17)).alias("h"), "lang", "text").collect()
        held: dict[str, list[str]] = {}
        for row in sorted(picked, key=lambda r: r["h"]):
            held.setdefault(row["lang"], []).append(row["text"])
        for lang in set(some) & set(totals) - set(held):
            held[lang] = [r["text"] for r in named.where((F.col("lang") == lang) & (F.octet_length("text") <= LONGEST_SAMPLED)).limit(1).collect()]
        for lang in set(some) - set(totals):
            pieces = named.where(F.col("lang") == lang).select(F.xxhash64("doc_id", F.lit(17)).alias("h"), middle.alias("text"))
            held[lang] = [r["text"] for r in pieces.orderBy("h", "text").limit(LONG_TEXTS).collect()]
        yield fit(held)
