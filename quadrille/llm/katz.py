"""Katz backoff language model over words, of any order, counted and evaluated at once.

For a word after a history of ``order - 1`` words (padded with starts):

* seen: ``d(r) * r / c(history)``, with Good-Turing discounts for counts up to K
  and one fixed factor above, so every history keeps mass for new words;
* unseen: the history's backoff weight times the probability after the history
  without its first word, and so on; a history that training lacks has weight 1;
* a word that training lacks has the mass that the unigram discounts leave.

Backoff weights are exact: what the discounts of a history's n-grams leave, over
what the words not seen there have after the shorter history.

Every token goes, as a packed record of its n-gram, to the partition that owns a
suffix of it: its word, or for a frequent word the last two words, and so on.
All n-grams that end in that suffix meet there, so a token's counts of every
order are settled in one place, in a partition of about ``part_tokens`` tokens.
Where the word that the suffix begins with is rare, it owns the token itself.
Suffixes frequent enough to make a partition uneven are counted ahead, exactly,
in tables of fixed greatest size.  A partition gives, in a written table, sums
per document, counts of counts per history, and the histories at which a document
backs off.  Discounts and backoff weights follow by aggregation, into tables that
are partitioned by the length of the histories, and the recursion down the
histories of every token by joins with these.

A chunk of texts packs its tokens by one sort, and only into partitions that get
some, so that its cost doesn't depend on how many there are.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadrille.llm._bytes import NOT_SPACE, U64, hashes, mix, texts, words
from quadrille.llm._marks import marks, with_mark
from quadrille.llm._store import Scratch, lean

#: Counts up to K are discounted by Good-Turing, greater ones by this factor.
K, LARGE = 5, 0.995
#: Greatest size of each table of frequent suffixes; places in the table of words have 16 bits.
HOT = 1 << 16
PART_TOKENS = 700_000
ORDER = 2
_CHUNK, _ROWS = 2 << 20, 50_000
_MUL = U64(0x9E3779B97F4A7C15)
END, START = U64(0xE0D), U64(0x57A27)
#: Classes of counts: 1 to K, and more.
_KINDS = K + 1


class Tokens(NamedTuple):
    """Tokens of the texts of a chunk: words and one end each."""

    first: int
    #: By distance: the token itself, the word before it, and so on.
    words: np.ndarray
    doc: np.ndarray
    sizes: np.ndarray
    #: Of each token in its text.
    nth: np.ndarray


def _tokens(column: pa.Array, order: int) -> Iterator[Tokens]:
    for at in range(0, len(column), _ROWS):
        for t in texts(column.slice(at, _ROWS), _CHUNK):
            w = words(t, NOT_SPACE)
            rows = len(w.bounds) - 1
            sizes = np.diff(w.bounds) + 1
            word = np.full(len(w.starts) + rows, END)
            inner = np.ones(len(word), bool)
            inner[np.cumsum(sizes) - 1] = False
            word[inner] = hashes(t.data, w.starts, w.ends)
            nth = np.arange(len(word)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            yield Tokens(at + t.first, _back(word, nth, order, START), np.repeat(np.arange(rows), sizes), sizes, nth)


def _back(values: np.ndarray, nth: np.ndarray, order: int, start) -> np.ndarray:
    """Values of the tokens, of the tokens before them, and so on; ``start`` ahead of a text."""
    out = np.full((order, len(values)), start, values.dtype)
    out[0] = values
    for k in range(1, order):
        np.copyto(out[k, k:], values[:-k], where=nth[k:] >= k)
    return out


def _grams(back: np.ndarray) -> list[np.ndarray]:
    """Hashes of the suffixes of one word, two words, and so on."""
    out = [back[0]] if len(back) else []
    for word in back[1:]:
        out.append(mix((out[-1] * _MUL) ^ word))
    return out


class _Top:
    """Approximate counts of the commonest keys of one task."""

    def __init__(self, most: int) -> None:
        self.most, self.keys, self.counts, self.total = most, np.zeros(0, np.int64), np.zeros(0, np.int64), 0

    def add(self, keys: np.ndarray) -> None:
        self.total += len(keys)
        new, n = np.unique(keys, return_counts=True)
        both, at = np.unique(np.concatenate([self.keys, new]), return_inverse=True)
        sums = np.bincount(at, np.concatenate([self.counts, n]), len(both)).astype(np.int64)
        if len(both) > 4 * self.most:
            top = np.argpartition(-sums, self.most)[: self.most]
            both, sums = both[top], sums[top]
        self.keys, self.counts = both, sums

    def result(self) -> tuple[np.ndarray, np.ndarray]:
        """Keys with more than their even share of what a table of this size can hold."""
        ok = (self.counts > 1) & (self.counts * 4 * self.most >= self.total)
        return self.keys[ok], self.counts[ok]


class Level(NamedTuple):
    """Frequent suffixes of one length: sorted hashes, exact counts in training, their histories, and places of the suffixes one word shorter."""

    ids: np.ndarray
    n: np.ndarray
    history: np.ndarray
    shorter: np.ndarray


def _place(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Places of keys in a sorted table, or -1."""
    if not len(table):
        return np.full(len(keys), -1)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return np.where(table[at] == keys, at, -1)


def _frequent(hot: list[Level], grams: list[np.ndarray]) -> list[np.ndarray]:
    """By length the places of the suffixes in the tables, or -1; a suffix counts only if all shorter ones do."""
    out: list[np.ndarray] = []
    for level, g in zip(hot, grams, strict=False):
        if out:
            at = np.full(len(g), -1)
            some = np.flatnonzero(out[-1] >= 0)
            at[some] = _place(level.ids, g[some])
            out.append(at)
        else:
            out.append(_place(level.ids, g))
    return out


_KEYS = "kind int, id bigint, n bigint, history bigint, shorter bigint"


def _rows(kind: int, keys: np.ndarray, n: np.ndarray, history: np.ndarray | None = None, shorter: np.ndarray | None = None) -> pa.RecordBatch:
    zero = np.zeros(len(keys), np.int64)
    longs = [keys, n, zero if history is None else history.view(np.int64), zero if shorter is None else shorter]
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(keys), kind, np.int32)), *[pa.array(x.astype(np.int64)) for x in longs]], [f.split()[0] for f in _KEYS.split(", ")]
    )


PROPOSED, COUNTED, TOTAL = range(3)


def _count(shared, order: int, most: int):
    """Exact counts of the longest suffixes that have a table, and proposals for the next."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot, top = shared.value, _Top(most)
        size = len(hot[-1].ids) if hot else 0
        sums, seen = np.zeros(size, np.int64), np.zeros(size, bool)
        history, shorter = np.zeros(size, U64), np.zeros(size, np.int64)
        docs = tokens = every = 0
        for batch in lean(batches):
            train = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            for t in _tokens(batch.column(0), min(order, len(hot) + 1)):
                learn = train[t.first : t.first + len(t.sizes)]
                grams = _grams(t.words)
                at = _frequent(hot, grams)
                if hot:
                    some = np.flatnonzero(at[-1] >= 0)
                    held = at[-1][some]
                    seen[held] = True
                    sums += np.bincount(held[learn[t.doc[some]]], minlength=size)
                    if len(hot) > 1:
                        history[held] = _grams(t.words[1 : len(hot)])[-1][some]
                        shorter[held] = at[-2][some]
                else:
                    some = np.arange(len(t.doc))
                if len(hot) < order:
                    top.add(grams[len(hot)][some].view(np.int64))
                docs += int(learn.sum())
                tokens += int(t.sizes[learn].sum())
                every += len(t.doc)
        yield _rows(PROPOSED, *top.result())
        yield _rows(COUNTED, np.flatnonzero(seen), sums[seen], history[seen], shorter[seen])
        yield _rows(TOTAL, np.arange(3), np.array([docs, tokens, every]))

    return count


#: A partition's tokens from one chunk: which of their words are in the table (bits), the
#: places of those, the other words, the number of the document, and the documents' keys and
#: whether they train; or what was settled where it stood.
_PACK = ("bits", "places", "words", "number", "keys", "train", "sums", "open")


def _sum_type(order: int) -> np.dtype:
    return np.dtype(
        [("key", "<i8"), ("id", "<i8"), ("size", "<i8"), ("x", "<f8"), ("base", "<f8"), ("known", "<i8"), ("s", "<i8", _KINDS * order + 1)]
    )


#: A history at which a document backs off, and what of it enters the score.
_OPEN = np.dtype([("h", "<u8"), ("key", "<i8"), ("use", "<i8")])
WEIGHT, BOTH, COUNT = range(3)


def _settle(last: np.ndarray, c: list[np.ndarray], back: np.ndarray, doc: np.ndarray, docs: int) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray, int]]]:
    """Per document what its tokens, whose suffixes of every length were counted ``c`` times, add up to; and (tokens, histories, use)."""
    order = len(c)
    out = np.zeros(docs, _sum_type(order))

    def put(name: str, at: np.ndarray, what: np.ndarray | None = None) -> None:
        out[name] += np.bincount(doc[at], what, docs).astype(out.dtype[name])

    known = np.flatnonzero(c[0] > 0)
    put("known", known)
    put("base", known, np.log10(c[0][known] + 1.0))
    # Whatever follows here is divided by the count of its longest history.
    past = np.flatnonzero((last != END) & (c[-2] > 0))
    put("x", past, -np.log10(c[-2][past]))
    best = sum((x > 0).astype(np.int64) for x in c)
    width = _KINDS * order + 1
    kind = np.full(len(best), width - 1)
    for k in range(1, order + 1):
        some = np.flatnonzero(best == k)
        put("x", some, np.log10(c[k - 1][some]))
        kind[some] = (order - k) * _KINDS + np.minimum(c[k - 1][some], K + 1) - 1
    out["s"] = np.bincount(doc * width + kind, minlength=docs * width).reshape(docs, width)
    open_ = []
    histories = _grams(back[1:])
    for k in range(2, order + 1):
        h = histories[k - 2]
        uses = ((best < k, WEIGHT),) if k == order else ((best < k, BOTH), (best == k, COUNT))
        for which, use in uses:
            some = np.flatnonzero(which)
            open_.append((some, h[some], use))
    return out, open_


def _opened(open_: list, keys: np.ndarray) -> np.ndarray:
    """Records of histories, ``keys`` by token."""
    out = np.zeros(sum(len(some) for some, _, _ in open_), _OPEN)
    at = 0
    for some, h, use in open_:
        part = out[at : at + len(some)]
        part["h"], part["key"], part["use"] = h, keys[some], use
        at += len(some)
    return out


def _differs(values: np.ndarray) -> np.ndarray:
    """Whether each differs from the one before it."""
    out = np.ones(len(values), bool)
    np.not_equal(values[1:], values[:-1], out=out[1:])
    return out


def _binary(data: np.ndarray, edges: np.ndarray) -> pa.Array:
    """Slices ``edges[i]:edges[i + 1]`` of an array, as bytes."""
    data = np.ascontiguousarray(data)
    offsets = (edges * data.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(edges) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _pack(shared, order: int, parts: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot, turn = shared.value, 0
        names = ["part", *_PACK]
        for batch in lean(batches):
            keys, ids = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            train = batch.column(3).to_numpy(zero_copy_only=False).astype(bool)
            for t in _tokens(batch.column(2), order):
                rows = len(t.sizes)
                own, learn = keys[t.first : t.first + rows].astype(np.int64), train[t.first : t.first + rows]
                grams = _grams(t.words)
                at = _frequent(hot, grams)
                here = np.flatnonzero(at[-1] >= 0)
                c = [level.n[a[here]] for level, a in zip(hot, at, strict=True)]
                sums, open_ = _settle(t.words[0, here], c, t.words[:, here], t.doc[here], rows)
                sums["key"], sums["id"], sums["size"] = own, ids[t.first : t.first + rows], t.sizes
                opened = _opened(open_, own[t.doc[here]])

                rest = np.flatnonzero(at[-1] < 0)
                place = _back(at[0], t.nth, order, _place(hot[0].ids, np.array([START]))[0])
                # The first suffix that isn't frequent owns the token, or its first word where that is rare.
                owner = np.empty(len(rest), U64)
                depth = sum((a[rest] >= 0).astype(np.int8) for a in at)
                for k, g in enumerate(grams):
                    own_k = np.flatnonzero(depth == k)
                    i = rest[own_k]
                    owner[own_k] = np.where(place[k, i] < 0, t.words[k, i], g[i])
                owner = mix(owner * _MUL)
                part = (((owner >> U64(32)) * U64(parts)) >> U64(32)).astype(np.int64)
                pair = part * rows + t.doc[rest]
                by = np.argsort(pair)
                rest, part, pair = rest[by], part[by], pair[by]
                place = place[:, rest].T
                starts = np.flatnonzero(_differs(part))
                edges = np.append(starts, len(part))
                # Documents of each partition, numbered there.
                opens = _differs(pair)
                pairs, number = pair[opens], np.cumsum(opens) - 1
                first = np.append(number[starts], len(pairs))
                number -= np.repeat(first[:-1], np.diff(edges))
                inside = place >= 0
                bits = np.zeros(len(rest), np.uint8)
                for k in range(order):
                    bits |= inside[:, k].astype(np.uint8) << np.uint8(k)
                count = np.concatenate([[0], np.cumsum(inside.sum(1))])
                columns = {
                    "bits": _binary(bits, edges),
                    "places": _binary(place[inside].astype(np.uint16), count[edges]),
                    "words": _binary(t.words[:, rest].T[~inside], edges * order - count[edges]),
                    "number": _binary(number.astype(np.uint16), edges),
                    "keys": _binary(own[pairs % rows], first),
                    "train": _binary(learn[pairs % rows], first),
                }
                none = _binary(np.zeros(0, np.uint8), np.zeros(len(edges), np.int64))
                arrays = [pa.array(part[starts], pa.int32()), *[columns.get(n, none) for n in _PACK]]
                yield pa.RecordBatch.from_arrays(arrays, names)
                turn += 1
                some = {"sums": sums, "open": opened}
                spot = int(mix(np.array([int(own[0]) & (2**63 - 1)], U64) + U64(turn))[0] % U64(parts))
                arrays = [pa.array([spot], pa.int32()), *[pa.array([some[n].tobytes() if n in some else b""], pa.binary()) for n in _PACK]]
                yield pa.RecordBatch.from_arrays(arrays, names)

    return pack


#: Kinds of rows that partitions give; rows of histories and of totals have the length of their n-grams added.
OF_DOC, WHOLE_DOC, BACKOFF, TOTALS, HISTORY = 0, 1, 2, 100, 200


def _columns(order: int) -> list[str]:
    return [f"s{k}" for k in range(_KINDS * order + 1)]


def _schema(order: int) -> pa.Schema:
    longs = [(n, pa.int64()) for n in _columns(order)]
    return pa.schema([("kind", pa.int32()), ("id", pa.int64()), ("other", pa.int64()), ("size", pa.int64()), ("x", pa.float64()), ("base", pa.float64()), ("known", pa.int64()), *longs])


def _out(schema: pa.Schema, kind: int, s: np.ndarray | None = None, **columns: np.ndarray) -> pa.RecordBatch:
    """A batch with the given columns and zeros."""
    size = len(columns["id"])
    zero = np.zeros(size, np.int64)
    columns |= {"kind": np.full(size, kind, np.int32)} | ({f"s{k}": x for k, x in enumerate(s.T)} if s is not None else {})
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(columns.get(f.name, zero)), type=f.type, safe=False) for f in schema], schema=schema)


def _spread(of: np.ndarray, value: np.ndarray, groups: int) -> np.ndarray:
    """Per group how many values are 1, ..., K, and the sum of those above K."""
    small = value <= K
    out = np.bincount(of[small] * _KINDS + value[small] - 1, minlength=groups * _KINDS).reshape(groups, _KINDS)
    out[:, -1] = np.bincount(of[~small], value[~small], groups)
    return out


def _unpack(table: pa.Table, hot: list[Level], order: int) -> tuple:
    """(words by distance, documents of the tokens, keys and training of the documents, settled sums, opened histories)."""
    held: dict[str, list] = {n: [] for n in ("back", "doc", "keys", "train", "sums", "open")}
    shift = 0
    for batch in table.select(_PACK).to_batches():
        for i in range(batch.num_rows):
            get = {n: batch.column(k)[i].as_buffer() for k, n in enumerate(_PACK)}
            bits = np.frombuffer(get["bits"], np.uint8)
            inside = (bits[:, None] >> np.arange(order)) & 1 > 0
            back = np.empty(inside.shape, U64)
            back[inside] = hot[0].ids[np.frombuffer(get["places"], np.uint16)]
            np.logical_not(inside, out=inside)
            back[inside] = np.frombuffer(get["words"], U64)
            held["back"].append(back.T)
            held["doc"].append(np.frombuffer(get["number"], np.uint16).astype(np.int64) + shift)
            held["keys"].append(np.frombuffer(get["keys"], np.int64))
            held["train"].append(np.frombuffer(get["train"], bool))
            held["sums"].append(np.frombuffer(get["sums"], _sum_type(order)))
            held["open"].append(np.frombuffer(get["open"], _OPEN))
            shift += len(held["keys"][-1])
    return tuple(np.concatenate(held[n], axis=n == "back" and 1 or 0) for n in held)


def _resolve(shared, order: int):
    schema = _schema(order)

    def resolve(table: pa.Table) -> pa.Table:
        hot, out = shared.value, []
        back, doc, keys, train, sums, opened = _unpack(table, hot, order)

        def give(kind: int, found: np.ndarray) -> None:
            out.append(_out(schema, kind, found["s"], id=found["key"], other=found["id"], size=found["size"], x=found["x"], base=found["base"], known=found["known"]))

        give(WHOLE_DOC, sums)
        learn = train[doc]
        grams, histories = _grams(back), [None, *_grams(back[1:])]
        c: list[np.ndarray] = []
        for k, (level, g, at) in enumerate(zip(hot, grams, _frequent(hot, grams), strict=True)):
            here = np.flatnonzero(at < 0)
            _, one, of = np.unique(g[here], return_index=True, return_inverse=True)
            found = np.bincount(of, learn[here], len(one)).astype(np.int64)
            count = np.zeros(len(g), np.int64)
            rest = np.flatnonzero(at >= 0)
            count[rest], count[here] = level.n[at[rest]], found[of]
            c.append(count)
            seen = found > 0
            total = np.append(np.bincount(np.minimum(found, K + 2), minlength=K + 3)[1 : K + 2], seen.sum())
            out.append(_out(schema, TOTALS + k + 1, np.pad(total, (0, _KINDS * order + 1 - len(total)))[None], id=np.zeros(1, np.int64)))
            if k:
                token = here[one[seen]]
                owners, first, of = np.unique(histories[k][token], return_index=True, return_inverse=True)
                s = np.concatenate([_spread(of, found[seen], len(owners)), _spread(of, c[k - 1][token], len(owners))], 1)
                shorter = histories[k - 1][token[first]].view(np.int64) if k > 1 else np.zeros(len(owners), np.int64)
                out.append(_out(schema, HISTORY + k + 1, s, id=owners.view(np.int64), other=shorter))
        if len(doc):
            own, open_ = _settle(back[0], c, back, doc, len(keys))
            own["key"] = keys
            give(OF_DOC, own)
            opened = np.concatenate([opened, _opened(open_, keys[doc])])
        out.append(_out(schema, BACKOFF, id=opened["h"].view(np.int64), other=opened["key"], size=opened["use"]))
        return pa.Table.from_batches(out, schema=schema)

    return resolve


def discounts(n: list[int]) -> np.ndarray:
    """Factors for counts 1 to K and above, from the numbers of kinds counted 1 to K + 1 times.

    Where Good-Turing gives no factor between 0 and 1, half a count is taken off.
    """
    out = np.append((np.arange(1, K + 1) - 0.5) / np.arange(1, K + 1), LARGE)
    if min(n) > 0:
        share = (K + 1) * n[K] / n[0]
        found = np.array([((r + 1) * n[r] / (r * n[r - 1]) - share) / (1 - share) if share < 1 else 0 for r in range(1, K + 1)])
        if ((found > 0) & (found < 1)).all():
            out[:K] = found
    return out


class Discounts(NamedTuple):
    """Discounts by length of the n-grams, and what training holds."""

    of: list[np.ndarray]
    tokens: int
    docs: int
    kinds: int
    unknown: float


def _hot_tables(given: DataFrame, order: int, most: int, scratch: Scratch) -> tuple[list[Level], list[int]]:
    """Tables of the frequent suffixes of every length, and (documents, tokens of training; all tokens)."""
    spark = given.sparkSession
    hot: list[Level] = []
    texts_and_fold = given.select("text", "train")
    proposed = np.zeros(0, np.int64)
    for turn in range(order + 1):
        if turn:
            fixed = [END, START] if turn == 1 else []
            ids = np.unique(np.concatenate([proposed.view(U64), np.array(fixed, U64)])).astype(U64)
            hot.append(Level(ids, np.zeros(len(ids), np.int64), np.zeros(len(ids), U64), np.zeros(len(ids), np.int64)))
        found = texts_and_fold.mapInArrow(_count(spark.sparkContext.broadcast(hot), order, most), _KEYS)
        found = found.groupBy("kind", "id").agg(F.sum("n").alias("n"), F.min("history").alias("history"), F.min("shorter").alias("shorter"))
        found = scratch.save(found, f"frequent-{turn}")
        # Of the proposals only the commonest reach the driver; the other kinds are bounded.
        some = found.where(F.col("kind") != PROPOSED).unionByName(
            found.where(F.col("kind") == PROPOSED).orderBy(F.desc("n"), "id").limit(most - 2)
        ).toArrow()
        kind, id_, n, history, shorter = (some.column(k).to_numpy() for k in range(5))
        if turn:
            at = kind == COUNTED
            for name, value in (("n", n), ("history", history.view(U64)), ("shorter", shorter)):
                getattr(hot[-1], name)[id_[at]] = value[at]
        totals = np.zeros(3, np.int64)
        totals[id_[kind == TOTAL]] = n[kind == TOTAL]
        proposed = id_[kind == PROPOSED]
    return hot, totals.tolist()


def score_katz(
    docs: DataFrame,
    train: Column | None = None,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    order: int = ORDER,
    part_tokens: int = PART_TOKENS,
    hot: int = HOT,
) -> DataFrame:
    """One row per document: doc_id, n_tokens, n_known, train_tokens, base_score, score.

    ``train`` says which rows to learn from (all, if left out); ``order`` is the
    length of the longest n-grams, 2 at least.  Tokens are the words, A-Z in
    lower case, and one end; scores are base-10 logarithms, and ``base_score`` is
    the add-one unigram score.  Null and empty texts have one token, the end;
    texts of any length are read whole.  Rows that repeat an id are scored each
    by its own text (they are told apart by 64 bits of a hash of id and text).
    Rows with a null id are neither learned from nor scored; they come back with
    null scores.  With nothing to learn from, every token has probability 1.
    Ids are integers; other columns are ignored; an empty table gives an empty
    result.
    """
    if order < 2 or hot > HOT:
        raise ValueError(f"the order is at least 2, and tables of frequent suffixes hold at most {HOT}")
    spark = docs.sparkSession
    scratch = Scratch(spark, "katz")
    every = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.coalesce(train if train is not None else F.lit(True), F.lit(False)).alias("train")
    )
    given = every.where("doc_id is not null")
    tables, (trained, n_tokens, all_tokens) = _hot_tables(given, order, hot, scratch)

    # A row goes by its id, or where that is repeated by a hash of id and text.
    repeated = scratch.save(given.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id"), "repeated")
    keyed = with_mark(given, F.col("doc_id"), marks(repeated, F.col("doc_id")), "maybe")
    own = F.when(F.col("maybe"), F.xxhash64("doc_id", F.coalesce("text", F.lit("")))).otherwise(F.col("doc_id"))
    parts = max(1, -(-all_tokens // part_tokens))
    shared = spark.sparkContext.broadcast(tables)
    packed = keyed.select(own.alias("key"), "doc_id", "text", "train").mapInArrow(_pack(shared, order, parts), "part int, " + ", ".join(f"{n} binary" for n in _PACK))
    kinds = "kind int, id bigint, other bigint, size bigint, x double, base double, known bigint, " + ", ".join(f"{n} bigint" for n in _columns(order))
    solved = scratch.save(packed.groupBy("part").applyInArrow(_resolve(shared, order), kinds), "solved")

    # Discounts from the numbers of n-grams by count; the tables hold the rest of them.
    sums = [F.sum(f"s{k}").alias(f"s{k}") for k in range(K + 2)]
    total = {r["kind"] - TOTALS: r for r in solved.where(F.col("kind").between(TOTALS + 1, TOTALS + order)).groupBy("kind").agg(*sums).collect()}
    of, kinds_by = [], []
    for k, level in enumerate(tables, 1):
        own_kinds = np.bincount(np.minimum(level.n, K + 2), minlength=K + 3)[1 : K + 2]
        kinds_by.append([int(own_kinds[r]) + (total[k][f"s{r}"] if k in total else 0) for r in range(K + 1)])
        of.append(discounts(kinds_by[-1]))
    low = sum(r * kinds_by[0][r - 1] for r in range(1, K + 1))
    kept = sum(r * kinds_by[0][r - 1] * of[0][r - 1] for r in range(1, K + 1)) + LARGE * (n_tokens - low)
    distinct = int((tables[0].n > 0).sum()) + (total[1][f"s{K + 1}"] if 1 in total else 0)
    model = Discounts(of, n_tokens, trained, distinct, 1 - kept / n_tokens if n_tokens else 1.0)
    return _finish(every, solved, tables, model, scratch)


def _weights(solved: DataFrame, tables: list[Level], model: Discounts, scratch: Scratch) -> DataFrame:
    """(h, weight, c): logarithms of every history's backoff weight times its count, and of its count."""
    spark, order = solved.sparkSession, len(tables)
    number = lambda v: F.lit(float(v))
    rows = []
    for k in range(2, order + 1):
        above, below = model.of[k - 1], model.of[k - 2]
        n = [F.col(f"s{r}") for r in range(_KINDS)]
        u = [F.col(f"s{_KINDS + r}") for r in range(_KINDS)]
        counted = sum(n[r - 1] * r for r in range(1, K + 1)) + n[K]
        mass = sum(n[r - 1] * number(r * (1 - above[r - 1])) for r in range(1, K + 1)) + n[K] * number(1 - LARGE)
        taken = sum(u[r - 1] * number(r * below[r - 1]) for r in range(1, K + 1)) + u[K] * number(LARGE)
        level = F.lit(k).alias("level")
        rows.append(solved.where(F.col("kind") == HISTORY + k).select(level, "id", "other", counted.alias("c"), mass.alias("mass"), taken.alias("taken")))
        # The frequent n-grams, which are in no partition.
        t = tables[k - 1]
        known = t.n > 0
        r, c = t.n[known], tables[k - 2].n[t.shorter[known]]
        own = {
            "id": t.history[known].view(np.int64),
            # Every history has a row of its own from a partition or here; which has the shorter one doesn't matter.
            "other": (tables[k - 2].history[t.shorter[known]].view(np.int64) if k > 2 else np.zeros(len(r), np.int64)),
            "c": r,
            "mass": r * (1 - above[np.minimum(r, K + 1) - 1]),
            "taken": c * below[np.minimum(c, K + 1) - 1],
        }
        rows.append(spark.createDataFrame(pa.table(own)).select(level, "id", "other", "c", "mass", "taken"))
    every = rows[0]
    for more in rows[1:]:
        every = every.unionByName(more)
    every = every.groupBy("level", "id").agg(F.max("other").alias("other"), *[F.sum(x).alias(x) for x in ("c", "mass", "taken")])
    every = scratch.save(every, "histories", "level")
    # What the words seen after a history have after the shorter one: over all tokens, or over that one's count.
    over = number(max(1, model.tokens))
    weight = lambda divisor: F.log10(F.col("mass") / (1 - F.col("taken") / divisor)).alias("weight")
    count = F.log10("c").alias("c")
    found = every.where("level = 2").select(F.col("id").alias("h"), weight(over), count)
    for k in range(3, order + 1):
        shorter = every.where(F.col("level") == k - 1).select(F.col("id").alias("__id"), F.col("c").alias("__c"))
        longer = every.where(F.col("level") == k).join(shorter, F.col("other") == F.col("__id"))
        found = found.unionByName(longer.select(F.col("id").alias("h"), weight(F.col("__c")), count))
    return scratch.save(found, "weights")


def _finish(every: DataFrame, solved: DataFrame, tables: list[Level], model: Discounts, scratch: Scratch) -> DataFrame:
    order = len(tables)
    number = lambda v: F.lit(float(v))
    weights = _weights(solved, tables, model, scratch)
    asked = solved.where(F.col("kind") == BACKOFF).select("id", "other", "size").join(weights, F.col("id") == F.col("h"), "left")
    use = F.col("size")
    back = F.when(use == WEIGHT, F.col("weight")).when(use == BOTH, F.col("weight") - F.col("c")).otherwise(-F.col("c"))

    value = F.col("x") + F.col(f"s{_KINDS * order}") * number(np.log10(model.unknown))
    for k in range(1, order + 1):
        divisor = np.log10(max(1, model.tokens)) if k == 1 else 0.0
        for r in range(_KINDS):
            value += F.col(f"s{(order - k) * _KINDS + r}") * number(np.log10(model.of[k - 1][r]) - divisor)
    whole = F.col("kind") == WHOLE_DOC
    begun = number(np.log10(max(1, model.docs)))
    sums = solved.where(F.col("kind").isin(OF_DOC, WHOLE_DOC)).select(
        F.col("id").alias("key"),
        F.when(whole, F.col("other")).alias("doc_id"),
        F.when(whole, value - begun).otherwise(value).alias("score"),
        "base",
        "known",
        F.when(whole, F.col("size")).otherwise(F.lit(0)).alias("size"),
        whole.cast("long").alias("rows"),
    )
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    sums = sums.unionByName(
        asked.select(
            F.col("other").alias("key"), none.alias("doc_id"), F.coalesce(back, number(0)).alias("score"), number(0).alias("base"), zero.alias("known"), zero.alias("size"), zero.alias("rows")
        )
    )
    sums = sums.groupBy("key").agg(F.max("doc_id").alias("doc_id"), *[F.sum(x).alias(x) for x in ("score", "base", "known", "size", "rows")])
    floor = number(np.log10(model.tokens + model.kinds + 1))
    # Rows alike in id and text have one key.
    copies = F.explode(F.array_repeat(F.lit(0), F.col("rows").cast("int")))
    n_tokens = F.expr("size div rows")
    scored = sums.where("rows > 0").select(
        "doc_id",
        n_tokens.alias("n_tokens"),
        F.expr("known div rows").alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("base") / F.col("rows") - n_tokens * floor).alias("base_score"),
        (F.col("score") / F.col("rows")).alias("score"),
        copies.alias("__copy"),
    ).drop("__copy")
    nothing = [F.lit(None).cast(t).alias(c) for c, t in scored.dtypes[1:]]
    return scored.unionByName(every.where("doc_id is null").select("doc_id", *nothing))
