"""Evaluation texts inside training documents, by a distributed positional inverted index.

The documents are cut into shards of bounded size, and each shard is inverted where its documents are read: for
every term the list of the places, document and word position, where it stands. The shards are stored once and answer
any number of test items; no posting is shuffled. Terms are ranked by their document frequency over all documents.

A window of a test item is looked up from the list of its rarest term. The lists of its other terms, shifted by their
offsets in the window, are intersected with it: the next rarest first, the rest for the few places that are left. Runs
of enough consecutive words are exact phrase matches. Proximity matches may lack some words of a window, so they are
looked up from as many of its rarest terms that one at least must be there. A shard walks its own terms, so test items
none of whose rarest terms it has cost it nothing.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pandas as pd
from numpy.lib.stride_tricks import sliding_window_view
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..workspace import materialize, spread, whole_groups

_RUN = re.compile("[a-z0-9]+")
#: A place in a shard is one number: the document's ordinal above, the word position, moved up by half the room, below.
_BITS = 40
_HALF = 1 << (_BITS - 1)


def word_runs(text: str) -> list[str]:
    return _RUN.findall(text.lower())


def invert(shard: str, keys: list, words: list[str], docs: list[np.ndarray], positions: list[np.ndarray]) -> pd.DataFrame:
    """One row per term of a shard with its places in order, and one row, under the empty term, with the documents' ids."""
    codes, terms = pd.factorize(np.array(words, dtype=object))
    order = np.argsort(codes, kind="stable")
    code, doc, at = codes[order], np.concatenate(docs)[order], np.concatenate(positions)[order]
    cuts = np.flatnonzero(np.diff(code)) + 1
    fresh = np.ones(len(code), dtype="int64")
    fresh[1:] = (np.diff(code) != 0) | (np.diff(doc) != 0)
    n_docs = np.add.reduceat(fresh, np.concatenate([[0], cuts]))
    return pd.DataFrame(
        {
            "shard": shard,
            "term": ["", *terms],
            "n_docs": [0, *n_docs],
            "docs": [np.zeros(0, "int32"), *np.split(doc, cuts)],
            "positions": [np.zeros(0, "int32"), *np.split(at, cuts)],
            "keys": [keys, *[None] * len(terms)],
        }
    )


def store_index(docs: DataFrame, id_col: str, text_col: str, vocabulary: set[str] | None, least: int, shard_words: int = 2_000_000) -> DataFrame:
    """The index in shared storage: shard, term, n_docs, docs (ordinals in the shard), positions, keys.

    Documents with fewer than ``least`` words of the vocabulary aren't indexed; without a vocabulary every word is. A
    shard ends with the document that brings it to ``shard_words`` postings, and is one row group of one file, so that one
    task reads all of it.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(vocabulary)
    id_type = docs.schema[id_col].dataType.simpleString()

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, part, n = shipped.value, TaskContext.get().partitionId(), 0
        keys, words, ordinals, positions = [], [], [], []
        for b in batches:
            for key, text in zip(b["k"], b["t"]):
                if not isinstance(text, str):
                    continue
                ws = word_runs(text)
                at = range(len(ws)) if known is None else [i for i, w in enumerate(ws) if w in known]
                if len(at) < max(1, least):
                    continue
                words += ws if known is None else [ws[i] for i in at]
                ordinals.append(np.full(len(at), len(keys), dtype="int32"))
                positions.append(np.array(at, dtype="int32"))
                keys.append(key)
                if len(words) >= shard_words:
                    yield invert(f"{part}-{n}", keys, words, ordinals, positions)
                    keys, words, ordinals, positions, n = [], [], [], [], n + 1
        if keys:
            yield invert(f"{part}-{n}", keys, words, ordinals, positions)

    read = spread(docs.select(F.col(id_col).alias("k"), F.col(text_col).alias("t")))
    schema = f"shard string, term string, n_docs long, docs array<int>, positions array<int>, keys array<{id_type}>"
    return materialize(read.mapInPandas(build, schema), "postings", {"parquet.block.size": str(2**30)})


def anchors(rarity: np.ndarray, n: int) -> dict[int, set[int]]:
    """Offset of the rarest term of each window of ``n`` words, with the offsets of the next rarest of the windows that have it."""
    windows = sliding_window_view(rarity, n)
    first = np.argsort(windows, axis=1, kind="stable")[:, :2] + np.arange(len(windows))[:, None]
    out: dict[int, set[int]] = defaultdict(set)
    for a, b in zip(first[:, 0].tolist(), first[:, -1].tolist()):
        out[a].add(b)
    return out


def near_anchors(rarity: np.ndarray, n: int, need: int) -> dict[int, list[int]]:
    """Offsets of the n - need + 1 rarest terms of each window, with the starts of the windows; a window with ``need`` words in place has one of these."""
    rarest = np.argsort(sliding_window_view(rarity, n), axis=1, kind="stable")[:, : n - need + 1]
    out: dict[int, list[int]] = defaultdict(list)
    for s, offsets in enumerate(rarest.tolist()):
        for k in offsets:
            out[s + k].append(s)
    return out


@dataclass
class Lookups:
    """A block of test items, turned to the terms that they are looked up from."""

    items: list[tuple]  # (key, words)
    n: int
    need: int
    slop: int | None
    exact: dict[str, list[tuple[int, int, list[int]]]] = field(default_factory=lambda: defaultdict(list))
    near: dict[str, list[tuple[int, int, np.ndarray, list[int]]]] = field(default_factory=lambda: defaultdict(list))

    @classmethod
    def of(cls, items: list[tuple], frequency: dict[str, int], n: int, slop: int | None, near_share: float) -> Lookups:
        need = max(1, next((c for c in range(n + 1) if c / n >= near_share), n + 1))
        out = cls(items, n, need, slop)
        for i, (_, words) in enumerate(items):
            rarity = np.array([frequency.get(w, 0) for w in words], dtype="int64")
            for a, others in anchors(rarity, n).items():
                out.exact[words[a]].append((i, a, sorted(others)))
            if slop is not None:
                for a, windows in near_anchors(rarity, n, need).items():
                    part = np.arange(windows[0], windows[-1] + n)
                    out.near[words[a]].append((i, a, np.array(windows), part[np.argsort(rarity[part], kind="stable")].tolist()))
        return out


def has(places: np.ndarray | None, wanted: np.ndarray, slop: int = 0) -> np.ndarray:
    """Which of the wanted places, give or take ``slop`` words, are in a list of places."""
    if places is None:
        return np.zeros(len(wanted), dtype=bool)
    i = np.searchsorted(places, wanted - slop)
    return (i < len(places)) & (places[np.minimum(i, len(places) - 1)] <= wanted + slop)


def intersect(lists: dict[str, np.ndarray], words: list[str], start: np.ndarray, slop: int = 0) -> np.ndarray:
    """(starts x words): which words stand at their offsets from each start, list by list."""
    hits = np.zeros((len(start), len(words)), dtype=bool)
    for k, w in enumerate(words):
        hits[:, k] = has(lists.get(w), start + k, slop)
    return hits


def window_counts(hits: np.ndarray, n: int) -> np.ndarray:
    """Most hits within a window of ``n`` words, for each row."""
    sums = np.zeros((len(hits), hits.shape[1] + 1), dtype="int32")
    np.cumsum(hits, axis=1, out=sums[:, 1:])
    return (sums[:, n:] - sums[:, :-n]).max(axis=1)


def longest_run(hits: np.ndarray) -> np.ndarray:
    """Length of the longest run of True in each row."""
    best = np.zeros(len(hits), dtype="int64")
    run = np.zeros(len(hits), dtype="int64")
    for k in range(hits.shape[1]):
        run = (run + 1) * hits[:, k]
        np.maximum(best, run, out=best)
    return best


def exact_places(lists: dict[str, np.ndarray], q: Lookups) -> dict[int, list[np.ndarray]]:
    """By item, the starts where the rarest term of a window and the next rarest stand at their offsets."""
    found: dict[int, list[np.ndarray]] = defaultdict(list)
    for term in lists.keys() & q.exact.keys():
        for i, a, others in q.exact[term]:
            start = lists[term] - a
            keep = np.zeros(len(start), dtype=bool)
            for b in others:
                keep |= has(lists.get(q.items[i][1][b]), start + b)
            if keep.any():
                found[i].append(start[keep])
    return found


def may_hold(lists: dict[str, np.ndarray], words: list[str], start: np.ndarray, windows: np.ndarray, order: list[int], n: int, need: int, slop: int) -> np.ndarray:
    """The starts at which one of the windows lacks no more than n - need words, the rarest words asked first."""
    lacks = np.zeros((len(start), len(windows)), dtype="int16")
    for k in order:
        if not len(start):
            break
        missed = ~has(lists.get(words[k]), start + k, slop)
        lacks += missed[:, None] & ((windows <= k) & (k < windows + n))
        alive = lacks.min(axis=1) <= n - need
        start, lacks = start[alive], lacks[alive]
    return start


def near_places(lists: dict[str, np.ndarray], q: Lookups) -> dict[int, dict[int, tuple[int, set[int]]]]:
    """By item and document, the most words of a window near their places, and the starts that show so many."""
    found: dict[int, dict[int, tuple[int, set[int]]]] = defaultdict(dict)
    n, slop = q.n, q.slop or 0
    starts: dict[int, list[np.ndarray]] = defaultdict(list)
    for term in lists.keys() & q.near.keys():
        for i, a, windows, order in q.near[term]:
            # the term itself may stand up to slop words off its place: what no shift can save goes first
            start = may_hold(lists, q.items[i][1], lists[term] - a, windows, order, n, q.need, 2 * slop)
            if len(start):
                starts[i].append(start)
    for i, own in starts.items():
        start = np.unique(np.unique(np.concatenate(own))[:, None] + np.arange(-slop, slop + 1))
        for s in range(0, len(start), 20_000):
            at = start[s : s + 20_000]
            counts = window_counts(intersect(lists, q.items[i][1], at, slop), n)
            for x, c in zip(at[counts >= q.need].tolist(), counts[counts >= q.need].tolist()):
                d = x >> _BITS
                best = found[i].get(d, (0, set()))
                if c >= best[0]:
                    found[i][d] = (c, best[1] | {x} if c == best[0] else {x})
    return found


def search(shard: pd.DataFrame, q: Lookups) -> list[tuple]:
    """(doc, item, longest run, share of a window's words near its place) over one shard of the index.

    Without ``slop`` only exact phrases are returned; with it also documents where enough of a window's words stand
    within ``slop`` words of their places in any order. Their run is the longest of the best places.
    """
    wanted = {w for _, words in q.items for w in words}
    lists = {t: (d.astype("int64") << _BITS) + p + _HALF for t, d, p in zip(shard["term"], shard["docs"], shard["positions"]) if t in wanted}
    keys = shard["keys"][shard["term"] == ""].iloc[0]
    best: dict[tuple[int, int], tuple[int, float]] = {}
    for i, starts in exact_places(lists, q).items():
        start = np.unique(np.concatenate(starts))
        for s in range(0, len(start), 20_000):
            runs = longest_run(intersect(lists, q.items[i][1], start[s : s + 20_000]))
            for x, r in zip(start[s : s + 20_000][runs >= q.n].tolist(), runs[runs >= q.n].tolist()):
                at = (x >> _BITS, i)
                best[at] = (max(r, best.get(at, (0,))[0]), 1.0)
    if q.slop is not None:
        for i, docs in near_places(lists, q).items():
            for d, (c, starts) in docs.items():
                if (d, i) not in best:
                    best[d, i] = (int(longest_run(intersect(lists, q.items[i][1], np.array(sorted(starts)))).max()), c / q.n)
    return [(keys[d], q.items[i][0], r, share) for (d, i), (r, share) in best.items()]


def leaks(docs: DataFrame, doc_id: str, doc_text: str, items: DataFrame, item_id: str, item_text: str, n: int = 13, slop: int | None = None, near_share: float = 0.8, block_words: int = 1_000_000, max_vocabulary: int = 5_000_000) -> DataFrame:
    """(doc_id, item_id, run_length, near_share): documents that hold at least ``n`` consecutive words of an item.

    Words are maximal runs of a-z and 0-9 after lower-casing. With ``slop``, documents where at least
    ``near_share`` of a window's words stand within ``slop`` words of their places count too, whichever words are
    missing. Null texts, and items of fewer than ``n`` words, give no row; repeated documents and items each count;
    very long texts are indexed whole. The documents are tokenised and stored once, for the words of the items or,
    where these are more than ``max_vocabulary``, for all words; items are sent to the tasks in blocks of
    ``block_words`` words.
    """
    spark = docs.sparkSession
    d_type, i_type = docs.schema[doc_id].dataType.simpleString(), items.schema[item_id].dataType.simpleString()
    schema = f"doc {d_type}, item {i_type}, run_length long, near_share double"
    texts = items.select(item_id, item_text).filter(F.col(item_text).isNotNull())
    vocabulary: set[str] | None = set()
    for row in texts.toLocalIterator():
        words = word_runs(row[1])
        if len(words) >= n:
            vocabulary.update(words)
        if len(vocabulary) > max_vocabulary:
            vocabulary = None
            break
    if vocabulary is not None and not vocabulary:
        return spark.createDataFrame([], schema.replace("doc ", f"{doc_id} ", 1).replace("item ", f"{item_id} ", 1))
    index = store_index(docs, doc_id, doc_text, vocabulary, 1 if slop is not None else n)
    frequency = materialize(index.filter("term <> ''").groupBy("term").agg(F.sum("n_docs").alias("n")), "term-frequency")

    def answer(block: list[tuple]) -> DataFrame:
        words = spark.createDataFrame([(w,) for w in sorted({w for _, ws in block for w in ws})], "term string")
        counts = {r.term: r.n for r in frequency.join(words, "term").collect()}
        shipped = spark.sparkContext.broadcast(Lookups.of(block, counts, n, slop, near_share))

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for shard in whole_groups(batches, "shard"):
                yield pd.DataFrame(search(shard, shipped.value), columns=["doc", "item", "run_length", "near_share"])

        return index.select("shard", "term", "docs", "positions", "keys").mapInPandas(run, schema)

    results, block, size = [], [], 0
    for row in texts.toLocalIterator():
        ws = word_runs(row[1])
        if len(ws) < n:
            continue
        if block and size + len(ws) > block_words:
            results.append(answer(block))
            block, size = [], 0
        block.append((row[0], ws))
        size += len(ws)
    results.append(answer(block))
    found = reduce(DataFrame.unionAll, results)
    return found.select(F.col("doc").alias(doc_id), F.col("item").alias(item_id), "run_length", "near_share")
