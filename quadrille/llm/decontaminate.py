"""Benchmark decontamination with suffix arrays of the training text.

Documents are cut into shards of whole texts.  A shard's words are indexed by a
suffix array (prefix doubling, which sorts again only what is still tied), once,
in the order of as many words as a window has.  Every distinct benchmark window,
and with it every benchmark suffix of that many words, is found by binary search
in each shard.  A place in a document has one window of each length at most, so
that matches are at most so many as words, however often text repeats.  The
longest verbatim runs lie in what is hit; the hit stretches of documents and
items are sorted as suffixes together, to any depth, and neighbours compared.

Benchmark words, as hashes, are written by tasks to the shared folder in slices of a
fixed greatest size.  A shard is searched for the slices one after the other; a worker
reads and holds one of them at a time, and the driver none, so a benchmark of any
size works in the same memory.  Documents are not shuffled, and a shard's memory does not
depend on the corpus.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadrille.llm._bytes import ALNUM, hashes, texts, words
from quadrille.llm._store import Scratch, lean
from quadrille.llm.token_files import _opened as opened

#: Words of benchmark text in one slice.
SLICE_WORDS = 1_000_000


class Tests(NamedTuple):
    """Distinct windows of a benchmark slice and the items that they come from."""

    ids: list[str]
    #: Item words end to end, and for each the end of its item.
    words: np.ndarray
    ends: np.ndarray
    #: Per window its first word, its length, its item, and the number of its words among all windows' (its kind).
    starts: np.ndarray
    sizes: np.ndarray
    item: np.ndarray
    kind: np.ndarray
    #: Per kind its first window, and the set of its items: set k has items ``set_items[set_bounds[k] : set_bounds[k + 1]]``.
    first: np.ndarray
    set_of: np.ndarray
    set_bounds: np.ndarray
    set_items: np.ndarray


def build_tests(ids: list[str], column: pa.Array, window: int) -> Tests:
    """Windows of ``window`` words; an item of fewer, but not none, is one window."""
    pool, bounds = [], [0]
    for t in texts(column):
        w = words(t, ALNUM)
        pool.append(hashes(t.data, w.starts, w.ends))
        bounds += (w.bounds[1:] + bounds[-1]).tolist()
    pool = np.concatenate(pool) if pool else np.zeros(0, np.uint64)
    ends = np.repeat(np.array(bounds[1:], np.int64), np.diff(bounds)) if len(bounds) > 1 else np.zeros(0, np.int64)
    starts, sizes, item = [], [], []
    for i, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
        if b > a:
            n = max(1, b - a - window + 1)
            starts.append(np.arange(a, a + n))
            sizes.append(np.full(n, min(window, b - a)))
            item.append(np.full(n, i))
    if not starts:
        none = np.zeros(0, np.int64)
        return Tests(ids, pool, ends, none, none, none, none, none, none, np.zeros(1, np.int64), none)
    starts, sizes, item = (np.concatenate(x).astype(np.int64) for x in (starts, sizes, item))
    table = np.zeros((len(starts), window + 1), np.uint64)
    table[:, window] = sizes
    for k in range(window):
        has = sizes > k
        table[has, k] = pool[starts[has] + k]
    _, first, kind = np.unique(table, axis=0, return_index=True, return_inverse=True)
    kind = kind.reshape(-1)
    pairs = np.unique(np.stack([kind, item], 1), axis=0)
    cuts = np.flatnonzero(np.diff(pairs[:, 0])) + 1
    known: dict[bytes, int] = {}
    set_of, set_items = np.zeros(len(first), np.int64), []
    for k, held in enumerate(np.split(pairs[:, 1], cuts)):
        number = known.setdefault(held.tobytes(), len(known))
        set_of[k] = number
        if number == len(set_items):
            set_items.append(held)
    set_bounds = np.cumsum([0, *(len(x) for x in set_items)])
    return Tests(ids, pool, ends, starts, sizes, item, kind, first, set_of, set_bounds, np.concatenate(set_items))


def suffix_array(h: np.ndarray, ends: np.ndarray, depth: int) -> np.ndarray:
    """Positions in the order of the words from there to the text's end, up to ``depth`` words.

    ``ends`` has for every position the end of its text; a suffix that ends
    early comes first.
    """
    n = len(h)
    order = np.argsort(h, kind="stable")
    rank = np.empty(n, np.int64)
    new = np.ones(n, bool)
    new[1:] = h[order[1:]] != h[order[:-1]]
    slots, reach = np.arange(n), 1
    where = order
    while True:
        head = np.maximum.accumulate(np.where(new, slots, 0))
        rank[where] = head
        last = np.ones(len(new), bool)
        last[:-1] = new[1:]
        tied = ~(new & last)
        slots, where, head = slots[tied], where[tied], head[tied]
        if not len(slots) or reach >= depth:
            return order
        ahead = where + reach
        inside = ahead < ends[where]
        second = np.where(inside, rank[np.where(inside, ahead, 0)] + 1, 0)
        key = head * (n + 1) + second
        by = np.argsort(key, kind="stable")
        key, where = key[by], where[by]
        order[slots] = where
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        reach *= 2


def _search(t: Tests, h: np.ndarray, ends: np.ndarray, order: np.ndarray, pick: np.ndarray, past: bool) -> np.ndarray:
    """For each window the first place in ``order`` whose suffix isn't below it (``past``: is above it)."""
    low, high = np.zeros(len(pick), np.int64), np.full(len(pick), len(order), np.int64)
    while True:
        open_ = np.flatnonzero(low < high)
        if not len(open_):
            return low
        middle = (low[open_] + high[open_]) >> 1
        at, q, size = order[middle], t.starts[pick[open_]], t.sizes[pick[open_]]
        below = np.full(len(open_), past)
        rest, k = np.arange(len(open_)), 0
        while len(rest):
            p = at[rest] + k
            out = p >= ends[at[rest]]
            a, b = h[np.where(out, 0, p)], t.words[q[rest] + k]
            settled = out | (a != b)
            below[rest[settled]] = (out | (a < b))[settled]
            k += 1
            rest = rest[~settled & (size[rest] > k)]
        low[open_[below]] = middle[below] + 1
        high[open_[~below]] = middle[~below]


class Found(NamedTuple):
    """Matches in a shard: the number of the window's words, and the word position."""

    kind: np.ndarray
    at: np.ndarray


def find(t: Tests, h: np.ndarray, ends: np.ndarray, order: np.ndarray) -> Found:
    """Matches of the distinct windows in a shard with its suffix array, which is as deep as a window is long at least."""
    if not len(t.starts) or not len(h):
        return Found(np.zeros(0, np.int64), np.zeros(0, np.int64))
    low, high = _search(t, h, ends, order, t.first, False), _search(t, h, ends, order, t.first, True)
    count = high - low
    kind = np.repeat(np.arange(len(count)), count)
    ahead = np.arange(len(kind)) - np.repeat(np.cumsum(count) - count, count)
    return Found(kind, order[low[kind] + ahead])


def _stretches(starts: np.ndarray, size: int, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions that ``size`` words from ``starts`` cover, in order; for each where its stretch ends, as an index of these)."""
    edge = np.zeros(len(ends) + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + size, -1)
    at = np.flatnonzero(np.cumsum(edge)[:-1] > 0)
    last = np.ones(len(at), bool)
    last[:-1] = (at[1:] != at[:-1] + 1) | (ends[at[1:]] != ends[at[:-1]])
    stops = np.flatnonzero(last) + 1
    return at, stops[np.searchsorted(stops, np.arange(len(at)), "right")]


def longest_runs(t: Tests, h: np.ndarray, ends: np.ndarray, doc: np.ndarray, found: Found, window: int) -> dict[int, tuple[int, int, int]]:
    """By document: (words of the longest verbatim run, its word position, its item).

    The first place in the document with so long a run, and the first item with it.
    Time is that of sorting what is hit, not of the pairs of places.
    """
    best: dict[int, tuple[int, int, int]] = {}
    sizes = t.sizes[t.first]
    for size in np.unique(sizes[found.kind][sizes[found.kind] < window]):  # whole items
        of = sizes[found.kind] == size
        for at, k in sorted(zip(found.at[of].tolist(), found.kind[of].tolist(), strict=True)):
            held = (int(size), at, int(t.item[t.first[k]]))
            if best.get(int(doc[at]), (0,))[0] < size:
                best[int(doc[at])] = held
    full = sizes[found.kind] == window
    if not full.any():
        return best
    d_at, d_stop = _stretches(np.unique(found.at[full]), window, ends)
    known = np.zeros(len(t.first), bool)
    known[found.kind[full]] = True
    i_at, i_stop = _stretches(t.starts[known[t.kind]], window, t.ends)
    split, joined = len(d_at), np.concatenate([h[d_at], t.words[i_at]])
    stop = np.concatenate([d_stop, i_stop + split])
    order = suffix_array(joined, stop, len(joined))
    word, stop, order = joined.tolist(), stop.tolist(), order.tolist()
    rank = [0] * len(order)
    for r, i in enumerate(order):
        rank[i] = r
    # How many words a suffix has in common with the one before it in the order.
    common, shared = [0] * len(order), 0
    for i, r in enumerate(rank):
        if i and stop[i - 1] != stop[i]:
            shared = 0
        if r == 0:
            shared = 0
            continue
        j = order[r - 1]
        most = min(stop[i] - i, stop[j] - j)
        while shared < most and word[i + shared] == word[j + shared]:
            shared += 1
        common[r] = shared
        shared = max(0, shared - 1)
    # The nearest suffix of an item on either side.
    run, near = [0] * split, 0
    for r, i in enumerate(order):
        near = min(near, common[r])
        if i >= split:
            near = len(order)
        else:
            run[i] = near
    near = 0
    for r in range(len(order) - 1, -1, -1):
        i = order[r]
        if i >= split:
            near = len(order)
        else:
            run[i] = max(run[i], near)
        near = min(near, common[r])
    top: dict[int, tuple[int, int]] = {}
    for i, d in enumerate(doc[d_at].tolist()):
        if run[i] >= window and run[i] > top.get(d, (0, 0))[0]:
            top[d] = (run[i], i)
    for d, (size, i) in top.items():
        # The suffixes with as many words in common are together in the order.
        low = high = rank[i]
        while common[low] >= size:
            low -= 1
        while high + 1 < len(order) and common[high + 1] >= size:
            high += 1
        place = min(j for j in order[low : high + 1] if j >= split) - split
        item = int(t.item[np.searchsorted(t.starts, i_at[place], "right") - 1])
        if best.get(d, (0,))[0] < size:
            best[d] = (size, int(d_at[i]), item)
    return best


RESULT = pa.schema(
    [
        ("n_words", pa.int64()),
        ("n_hit", pa.int64()),
        ("items", pa.list_(pa.string())),
        ("longest", pa.int64()),
        ("longest_item", pa.string()),
        ("longest_at", pa.int64()),
    ]
)


def judge(column: pa.Array, slices: Callable[[], Iterator[Tests]], window: int, shard_bytes: int, runs: bool = True) -> Iterator[tuple[int, pa.Table]]:
    """(first row, results of the rows of a shard), shard by shard; ``slices`` starts the benchmark anew for each.

    Without ``runs`` the longest runs are left out.
    """
    for t in texts(column, shard_bytes):
        w = words(t, ALNUM)
        h = hashes(t.data, w.starts, w.ends)
        sizes = np.diff(w.bounds)
        rows = len(sizes)
        doc, ends = np.repeat(np.arange(rows), sizes), np.repeat(w.bounds[1:], sizes)
        edge = np.zeros(len(h) + 1, np.int64)
        items: list[set[str]] = [set() for _ in range(rows)]
        best, best_item, best_at = np.zeros(rows, np.int64), [None] * rows, np.full(rows, -1, np.int64)
        order = suffix_array(h, ends, window)
        for tests in slices():
            found = find(tests, h, ends, order)
            if not len(found.kind):
                continue
            np.add.at(edge, found.at, 1)
            np.add.at(edge, found.at + tests.sizes[tests.first[found.kind]], -1)
            for d, k in np.unique(np.stack([doc[found.at], tests.set_of[found.kind]], 1), axis=0).tolist():
                items[d].update(tests.ids[i] for i in tests.set_items[tests.set_bounds[k] : tests.set_bounds[k + 1]])
            if not runs:
                continue
            for d, (size, at, item) in longest_runs(tests, h, ends, doc, found, window).items():
                at -= w.bounds[d]
                if (size, -at) > (best[d], -best_at[d]):
                    best[d], best_item[d], best_at[d] = size, tests.ids[item], at
        hit = np.zeros(len(h) + 1, np.int64)
        np.cumsum(np.cumsum(edge)[:-1] > 0, out=hit[1:])
        n_hit = hit[w.bounds[1:]] - hit[w.bounds[:-1]]
        yield t.first, pa.table(
            [
                pa.array(sizes, pa.int64()),
                pa.array(n_hit, pa.int64()),
                pa.array([sorted(x) for x in items], pa.list_(pa.string())),
                pa.array(best, pa.int64()),
                pa.array(best_item, pa.string()),
                pa.array(best_at, pa.int64()),
            ],
            schema=RESULT,
        )


class Slices(NamedTuple):
    """The files of a benchmark's slices, in order, and how many slices they hold."""

    paths: list[str]
    count: int

    def in_turn(self) -> Callable[[], Iterator[Tests]]:
        """What starts the slices anew; only a slice that is the one of its benchmark is kept."""
        kept: list[Tests] = []

        def read() -> Iterator[Tests]:
            if kept:
                yield kept[0]
                return
            for path in self.paths:
                system, at = opened(path)
                with system.open_input_file(at) as file:
                    for batch in pq.ParquetFile(file).iter_batches(1, columns=["tests"]):
                        found = pickle.loads(batch.column(0)[0].as_buffer())
                        if self.count == 1:
                            kept.append(found)
                        yield found

        return read


def _slices(benchmark: DataFrame, id_col: str, text_col: str, window: int, slice_words: int) -> Slices:
    """The benchmark by ids, written in slices, each of at most ``slice_words`` words or of one item."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, held, size = [], [], 0

        def close() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([pickle.dumps(build_tests(ids, pa.array(held, pa.string()), window), 5)], pa.binary())], ["tests"])

        for batch in lean(batches):
            for item, text in zip(batch.column(0), batch.column(1), strict=True):
                text = text.as_py()
                more = len(text) // 2 + 1
                if ids and size + more > slice_words:
                    yield close()
                    ids, held, size = [], [], 0
                ids.append(item.as_py())
                held.append(text)
                size += more
        if ids:
            yield close()

    scratch = Scratch(benchmark.sparkSession, "benchmark")
    rows = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("i"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    size = rows.agg(F.sum(F.expr("length(t) div 2 + 1")).alias("n")).first()["n"] or 0
    dealt = rows.repartitionByRange(max(1, -(-size // slice_words)), "i").sortWithinPartitions("i", "t")
    saved = scratch.save(dealt.mapInArrow(build, "tests binary"), "slices")
    return Slices(sorted(saved.inputFiles()), saved.count())


def find_overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    window: int = 13,
    shard_bytes: int = 2 << 20,
    slice_words: int = SLICE_WORDS,
) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, items, longest, longest_item, longest_at.

    ``n_hit`` counts the words inside any occurrence of a window; ``items`` are
    the distinct ids (as text, sorted) of the items with an occurring window;
    ``longest`` is the longest verbatim run that starts at such an occurrence,
    with its item and its word position (null and -1 without one).  Null and
    empty texts have no words and no hits.  Items without words have no
    windows; a null item id reads ``null``.  Items with equal texts all count.
    Of equally long runs the one first in the document is given, and of its items
    that with the least id as text.  Texts of any length are read whole, a long one
    as a shard of its own.
    Repeated rows each get a row; other columns are ignored; empty tables give
    an empty result, or one without hits.
    """
    slices = _slices(benchmark, item_id_col, item_text_col, window, slice_words)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = slices.in_turn()
        for batch in lean(batches):
            for first, found in judge(batch.column(1), read, window, shard_bytes):
                ids = batch.column(0).slice(first, found.num_rows)
                yield from found.add_column(0, "doc_id", ids).combine_chunks().to_batches()

    given = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = given.schema["doc_id"].dataType.simpleString()
    return given.mapInArrow(
        scan,
        f"doc_id {kind}, n_words bigint, n_hit bigint, items array<string>, longest bigint, longest_item string, longest_at bigint",
    )


#: A document is contaminated when this share of its words or more is hit.
LEAST_SHARE = (1, 20)


def drop_contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    window: int = 13,
    shard_bytes: int = 2 << 20,
    slice_words: int = SLICE_WORDS,
) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns.

    Cases as in :func:`find_overlaps`; texts without words stay.
    """
    slices = _slices(benchmark, item_id_col, item_text_col, window, slice_words)
    place = docs.columns.index(text_col)
    part, whole = LEAST_SHARE

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = slices.in_turn()
        for batch in lean(batches):
            bad = np.zeros(batch.num_rows, bool)
            for first, found in judge(batch.column(place), read, window, shard_bytes, runs=False):
                n_words, n_hit = (found.column(k).to_numpy() for k in ("n_words", "n_hit"))
                bad[first : first + found.num_rows] = (n_hit > 0) & (whole * n_hit >= part * n_words)
            yield batch.filter(pa.array(~bad))

    return docs.mapInArrow(keep, docs.schema)
