"""Texts that hold benchmark items: greedy string tiling by running Karp-Rabin.

Words of texts and items are numbered by the benchmark's vocabulary. Texts are joined with items by shared
seeds, runs of ``LEAST`` words. Where the seeds of an item in a text span enough of the item, the two are tiled:
the longest match that overlaps no earlier one is marked, again and again, with hashes of windows
whose length falls by halves. The item counts as contained when its tiles cover enough of its words, wherever in the text and in
whatever order they stand.

The benchmark goes through in blocks of bounded words, and all texts pass each block; so a benchmark of any size
is compared whole, and what is broadcast stays bounded (by a block, or by one item if that is larger).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from paceforge.llm.common import chunks, strings

#: Words of the shortest tile, part of an item that tiles must cover, and words of a block.
LEAST, COVERAGE, BLOCK_WORDS = 5, 0.5, 500_000
WORDS = re.compile(r"\w+")
BASE = np.uint64(0x9E3779B97F4A7C15)


def window_hashes(ids: np.ndarray, n: int) -> np.ndarray:
    """Karp-Rabin hash of every window of n numbers, modulo 2**64, each from the one before."""
    if len(ids) < n:
        return np.empty(0, np.uint64)
    value = np.zeros(len(ids) - n + 1, np.uint64)
    for k in range(n) if n <= 16 else ():
        value = value * BASE + ids[k : k + len(value)].astype(np.uint64)
    if n <= 16:
        return value
    with np.errstate(over="ignore"):
        full, top = np.uint64(0), np.uint64(1)
        for k in range(n):
            full = full * BASE + np.uint64(ids[k])
            top = top * BASE
        value[0] = full
        for k in range(1, len(value)):
            full = full * BASE + np.uint64(ids[k + n - 1]) - top * np.uint64(ids[k - 1])
            value[k] = full
    return value


def tiles(item: np.ndarray, text: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """(length, place in item, place in text) of the tiles, longest first; number 0 matches nothing."""
    used_item, used_text = item == 0, text == 0
    found: list[tuple[int, int, int]] = []
    size = max(least, min(len(item), len(text)))
    while True:
        longest = _longest(item, text, used_item, used_text, size)
        if longest:
            for n, i, j in longest:
                if not used_item[i : i + n].any() and not used_text[j : j + n].any():
                    used_item[i : i + n] = used_text[j : j + n] = True
                    found.append((n, i, j))
        elif size == least:
            return found
        else:
            size = max(least, size // 2)


def _longest(item: np.ndarray, text: np.ndarray, used_item: np.ndarray, used_text: np.ndarray, size: int) -> list[tuple[int, int, int]]:
    """The longest matches of ``size`` or more between what isn't used, in order of place; all of one length."""

    def free(used: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(used)])
        return np.flatnonzero(sums[size:] == sums[:-size]) if len(used) >= size else np.empty(0, np.int64)

    at_item, at_text = free(used_item), free(used_text)
    if not len(at_item) or not len(at_text):
        return []
    here: dict[int, list[int]] = {}
    for i, h in zip(at_item.tolist(), window_hashes(item, size)[at_item].tolist()):
        here.setdefault(h, []).append(i)
    found, best = [], size
    for j, h in zip(at_text.tolist(), window_hashes(text, size)[at_text].tolist()):
        for i in here.get(h, ()):
            n, most = 0, min(len(item) - i, len(text) - j)
            while n < most and item[i + n] == text[j + n] and not used_item[i + n] and not used_text[j + n]:
                n += 1
            if n >= best:
                found.append((n, i, j))
                best = n
    return sorted(f for f in found if f[0] == best)


class Items:
    """The items of a block, with their seeds."""

    def __init__(self, rows: list[tuple]):
        self.ids = [item_id for item_id, _ in rows]
        words = [WORDS.findall((t or "").lower()) for _, t in rows]
        self.vocabulary = {w: k + 1 for k, w in enumerate(sorted({w for x in words for w in x}))}
        self.items = [np.array([self.vocabulary[w] for w in x], np.int64) for x in words]
        self.sizes = np.array([len(x) for x in words], np.int64)
        self.seeds = []  # by length of the seed: (hashes, starts, items, places)
        for n in sorted({min(LEAST, k) for k in self.sizes.tolist()} - {0}):
            of = [k for k, x in enumerate(self.items) if min(LEAST, len(x)) == n]
            hashes = np.concatenate([window_hashes(self.items[k], n) for k in of])
            item = np.concatenate([np.full(len(self.items[k]) - n + 1, k) for k in of])
            place = np.concatenate([np.arange(len(self.items[k]) - n + 1) for k in of])
            order = np.argsort(hashes, kind="stable")
            unique, starts = np.unique(hashes[order], return_index=True)
            self.seeds.append((n, unique, np.append(starts, len(order)), item[order], place[order]))

    def numbers(self, texts: list[str]) -> list[np.ndarray]:
        get = self.vocabulary.get
        return [np.array([get(w, 0) for w in WORDS.findall(t.lower())], np.int64) for t in texts]

    def contained(self, texts: list[str]) -> list[tuple[int, int, float, int]]:
        """(place of the text, place of the item, part covered, tiles) of all pairs with enough of the item covered."""
        each = self.numbers(texts)
        if not each or not self.seeds:
            return []
        flat = np.concatenate([x for ids in each for x in (ids, np.zeros(1, np.int64))])
        owner = np.repeat(np.arange(len(each)), [len(x) + 1 for x in each])
        start = np.concatenate([[0], np.cumsum([len(x) + 1 for x in each])])
        known = np.concatenate([[0], np.cumsum(flat == 0)])
        found = []
        for n, unique, starts, item, place in self.seeds:
            at = np.flatnonzero(known[n:] == known[:-n]) if len(flat) >= n else np.empty(0, np.int64)
            hashes = np.zeros(len(at), np.uint64)
            for k in range(n):
                hashes = hashes * BASE + flat[at + k].astype(np.uint64)
            slot = np.minimum(np.searchsorted(unique, hashes), len(unique) - 1)
            hit = unique[slot] == hashes
            at, slot = at[hit], slot[hit]
            for text, one in self._candidates(owner[at], slot, starts, item, place, n):
                ids = each[text]
                spans = np.zeros(len(ids) + n, np.int64)
                mine = at[(owner[at] == text) & self._has(slot[owner[at] == text], one, starts, item, owner[at] == text)] - start[text]
                np.add.at(spans, mine, 1)
                np.add.at(spans, mine + n, -1)
                inside = np.cumsum(spans)[: len(ids)] > 0
                near = np.where(inside, ids, 0)[inside | np.concatenate([[False], inside[:-1]])]  # spans with a 0 after each
                tiled = tiles(self.items[one], near, n)
                part = sum(t[0] for t in tiled) / len(self.items[one])
                if part >= COVERAGE:
                    found.append((text, one, part, len(tiled)))
        return found

    def _candidates(self, text: np.ndarray, slot: np.ndarray, starts: np.ndarray, item: np.ndarray, place: np.ndarray, n: int) -> list[tuple[int, int]]:
        """Pairs of a text and an item whose shared seeds span enough of the item; tiles can cover no more."""
        once = np.unique(text * np.int64(len(starts)) + slot)
        text, slot = once // len(starts), once % len(starts)
        found = []
        for a in range(0, len(text), 100_000):
            found.append(self._spans(text[a : a + 100_000], slot[a : a + 100_000], starts, item, place))
        if not found:
            return []
        text, one, at = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((at, one, text))
        text, one, at = text[order], one[order], at[order]
        new = np.concatenate([[True], (text[1:] != text[:-1]) | (one[1:] != one[:-1])])
        step = np.append(np.diff(at), n)
        step[np.append(new[1:], True)] = n
        group = np.cumsum(new) - 1
        spanned = np.bincount(group, np.minimum(step, n))
        text, one = text[new], one[new]
        enough = spanned >= COVERAGE * self.sizes[one] - 1e-9
        return list(zip(text[enough].tolist(), one[enough].tolist()))

    @staticmethod
    def _spans(text: np.ndarray, slot: np.ndarray, starts: np.ndarray, item: np.ndarray, place: np.ndarray) -> tuple:
        """A row for every place that a text's seeds have in items."""
        many = starts[slot + 1] - starts[slot]
        text = np.repeat(text, many)
        within = np.arange(len(text)) - np.repeat(np.cumsum(many) - many, many)
        at = np.repeat(starts[slot], many) + within
        return text, item[at], place[at]

    @staticmethod
    def _has(slot: np.ndarray, one: int, starts: np.ndarray, item: np.ndarray, mask: np.ndarray) -> np.ndarray:
        """Of the masked seeds of a text, those that the item has, as a mask over all."""
        out = np.zeros(len(mask), bool)
        mine = np.unique(slot)
        has = {s for s in mine.tolist() if (item[starts[s] : starts[s + 1]] == one).any()}
        out[mask] = [s in has for s in slot.tolist()]
        return out


def blocks(benchmark: DataFrame, item_id: str = "item_id", text: str = "text") -> Iterator[Items]:
    """The benchmark in blocks; items without a word are left out, as nothing can hold them."""
    rows = benchmark.select(F.col(item_id).alias("item_id"), F.col(text).alias("text")).where("text is not null")
    words = rows.agg(F.sum(F.size(F.split("text", r"\W+"))).alias("n")).first().n or 0
    count = max(1, -(-words // BLOCK_WORDS))
    for k in range(count if words else 0):
        part = rows.where(F.pmod(F.xxhash64("text"), F.lit(count)) == k)
        yield Items(sorted((tuple(r) for r in part.collect()), key=lambda r: (r[0] is not None, r[0], r[1])))


def contaminated(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id") -> DataFrame:
    """(doc_id, item_id, coverage, n_tiles) of every text and item whose tiles cover ``COVERAGE`` of the item or more.

    Null and empty texts hold nothing. Items of fewer than ``LEAST`` words must be there whole. Repeated rows are all
    looked at, repeated items too.
    """
    spark = docs.sparkSession
    kinds = dict(docs.select(doc_id).dtypes)[doc_id], dict(benchmark.select(item_id).dtypes)[item_id]
    schema = f"doc_id {kinds[0]}, item_id {kinds[1]}, coverage double, n_tiles int"
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    own = to_arrow_type(benchmark.schema[item_id].dataType)
    found = [source.mapInArrow(_finder(spark.sparkContext.broadcast(block), own), schema) for block in blocks(benchmark, item_id)]
    return reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], schema)


def _finder(held, kind: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = held.value
        for piece in chunks(batches):
            found = items.contained(strings(piece.column(1)))
            ids = piece.column(0).take(pa.array([f[0] for f in found], pa.int64()))
            own = pa.array([items.ids[f[1]] for f in found], kind)
            yield pa.RecordBatch.from_arrays([ids, own, pa.array([f[2] for f in found], pa.float64()), pa.array([f[3] for f in found], pa.int32())], ["doc_id", "item_id", "coverage", "n_tiles"])

    return run


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """Rows of ``docs``, whole, that hold no item."""
    spark = docs.sparkSession

    def keeper(held):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for piece in chunks(batches):
                hit = {f[0] for f in held.value.contained(strings(piece.column(piece.schema.get_field_index(text))))}
                yield piece.filter(pa.array([k not in hit for k in range(piece.num_rows)], pa.bool_()))

        return run

    return reduce(lambda df, block: df.mapInArrow(keeper(spark.sparkContext.broadcast(block)), docs.schema), blocks(benchmark), docs)
