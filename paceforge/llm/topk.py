"""Exact BM25 search: an inverted index per shard, block-max pruning, and an exact merge.

Queries go through in blocks of bounded words. The texts are split into words once for a block: of every text the numbers and counts of the words that
the block asks for are stored, with its length. Document frequencies, the number of texts and their mean length are counted over all of them, so a
score doesn't depend on where a text lies. The words of the queries and their weights are broadcast. The stored rows are dealt over tasks, every task
makes shards of what it reads, and answers all the block's queries on each, some together. Postings of the words that are rare in the shard are added up. Blocks
of neighbouring texts have the largest impact of each common word, which bounds what common words can add; only texts that can reach the bar of a query with that
get their common words, for all queries together in one matrix product, and what still reaches a query's bar is scored in full.

Samples of the texts are searched first, each ``SAMPLE`` times the one before. The k-th best text of a query in a sample is
never better than its k-th best of all, so it is the bar for the texts after it, and a shard gives only texts that reach it. Every text is searched behind the
samples. What a query gets from a pass is so about k times ``SAMPLE`` texts, however many shards there are and however many texts tie; they meet in one window per query.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from functools import reduce
from math import ceil, log

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paceforge.llm.common import chunks, stored, strings

K1, B, TOP = 1.2, 0.75, 10
#: Words of all queries of a block, about (a vocabulary of some 100 MB in a worker); texts and postings of a shard; neighbouring texts of a block.
QUERY_WORDS, SHARD_TEXTS, SHARD_POSTINGS, NEIGHBOURS = 12_000_000, 16_000, 5_000_000, 16
WORDS = re.compile(r"\w+")
#: A word that one of so many texts of a shard has is common there; common words at most, the most frequent; queries that are searched together.
COMMON, COMMON_WORDS, TOGETHER = 16, 1_024, 128
#: How many times a sample is the one before it, and parts of a pass at least; how much fuller a shard may be than it is on average.
SAMPLE, SAMPLE_PARTS, ROOM = 16, 4, 1.2
#: Postings weighed at a time.
STEP = 500_000
#: What rounding can move a bound by: sums of up to COMMON_WORDS impacts are in single precision.
SLACK = 1e-4
#: Stands for a missing id, which comes last.
LAST = np.iinfo(np.int64).max
ANSWERS = "query long, doc_id long, score double"


def words(text: str) -> list[str]:
    return WORDS.findall(text.lower())


def ranges(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The numbers from each start up to its end, one range after the other."""
    size = ends - starts
    out = np.ones(int(size.sum()), np.int64)
    full = size > 0
    starts, size = starts[full], size[full]
    if not len(starts):
        return np.empty(0, np.int64)
    out[0] = starts[0]
    at = np.cumsum(size)[:-1]
    out[at] = starts[1:] - (starts[:-1] + size[:-1] - 1)
    return np.cumsum(out)


def _counted(texts: list[str], vocabulary: dict[str, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(word, times) in order of text and word, of the words in the vocabulary; how many these are and how many words there are in all, of each text."""
    get = vocabulary.get
    rows, lengths = [], np.zeros(len(texts), np.int64)
    for k, t in enumerate(texts):
        own = words(t)
        lengths[k] = len(own)
        rows.append(np.array([n for w in own if (n := get(w)) is not None], np.int64))
    flat = np.concatenate([np.empty(0, np.int64), *rows])
    key = np.repeat(np.arange(len(texts)), [len(r) for r in rows]) * max(1, len(vocabulary)) + flat
    key, times = np.unique(key, return_counts=True)
    sizes = np.bincount(key // max(1, len(vocabulary)), minlength=len(texts))
    return (key % max(1, len(vocabulary))).astype(np.int32), times.astype(np.int32), sizes, lengths


def _packed(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """The bytes of the first so many values, the next so many, and so on."""
    offsets = np.concatenate([[0], np.cumsum(sizes)]) * values.itemsize
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))])


def _unpacked(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All values of a packed column, and how many each row has; the values are a view."""
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64) // 4
    values = np.frombuffer(data, np.int32, int(at[-1])) if data is not None and at[-1] else np.empty(0, np.int32)
    return values[at[0] :], np.diff(at)


def indexed(texts: DataFrame, vocabulary: Broadcast) -> DataFrame:
    """(doc_id, length, words, times): of every text the number of its words, and the numbers and counts of those in the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in chunks(batches):
            word, times, sizes, lengths = _counted(strings(piece.column(1)), vocabulary.value)
            yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(lengths), _packed(word, sizes), _packed(times, sizes)], ["doc_id", "length", "words", "times"])

    return texts.select("doc_id", "text").mapInArrow(run, "doc_id long, length long, words binary, times binary")


def document_frequencies(index: DataFrame, n_words: int) -> np.ndarray:
    """How many texts have each word of the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(n_words, np.int64)
        for batch in batches:
            found += np.bincount(_unpacked(batch.column(0))[0], minlength=n_words)
        word = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(found[word])], ["word", "df"])

    rows = index.select("words").mapInArrow(run, "word long, df long").groupBy("word").agg(F.sum("df").alias("df")).toArrow()
    df = np.zeros(n_words, np.int64)
    df[rows.column(0).to_numpy()] = rows.column(1).to_numpy()
    return df


class Shard:
    """An index of some texts by the words of a block of queries."""

    def __init__(self, ids: list, texts: list[str], vocabulary: dict[str, int], idf: np.ndarray, mean_length: float):
        self._fill(ids, *_counted(texts, vocabulary), idf, mean_length)

    @classmethod
    def of(cls, ids: list, word: np.ndarray, times: np.ndarray, sizes: np.ndarray, lengths: np.ndarray, idf: np.ndarray, mean_length: float) -> Shard:
        """A shard of texts that are counted."""
        shard = cls.__new__(cls)
        shard._fill(ids, word, times, sizes, lengths, idf, mean_length)
        return shard

    def _fill(self, ids: list, word: np.ndarray, times: np.ndarray, sizes: np.ndarray, lengths: np.ndarray, idf: np.ndarray, mean_length: float) -> None:
        n, n_words = len(ids), len(idf)
        starts = np.concatenate([[0], np.cumsum(sizes)])
        # texts whose commonest word is the same lie side by side, which keeps the bounds of blocks low
        commonest = np.full(n, -1)
        full = np.flatnonzero(sizes)
        if len(full):
            most = times.astype(np.int64)
            most *= n_words
            most += word
            commonest[full] = np.maximum.reduceat(most, starts[full]) % n_words
            del most
        order = np.lexsort((lengths, commonest))
        place = np.empty(n, np.int32)
        place[order] = np.arange(n)
        self.ids = [ids[k] for k in order.tolist()]
        self.number = np.array([LAST if k is None else k for k in self.ids], np.int64)
        self.missing = np.array([k is None for k in self.ids], bool)
        self.word, self.times, self.idf = word, times, idf
        self.starts, self.ends = starts[order], starts[order] + sizes[order]
        norm = K1 * (1 - B + B * lengths / max(mean_length, 1e-9))
        self.norm = norm[order]
        # places of the postings by word, sorted behind the words; in place, as these are the largest arrays
        bits = len(word).bit_length()
        by_word = word.astype(np.int64)
        by_word <<= bits
        for k in range(0, len(word), STEP):
            by_word[k : k + STEP] |= np.arange(k, min(k + STEP, len(word)))
        by_word.sort()
        by_word &= (1 << bits) - 1
        owner = np.repeat(np.arange(n, dtype=np.int32), sizes)
        impact = np.empty(len(word), np.float32)
        for k in range(0, len(word), STEP):
            some = slice(k, k + STEP)
            impact[some] = _impact(idf[word[some]], times[some], norm[owner[some]])
        # (text, impact) by word, the bits of an impact as a whole number
        self.postings = np.empty((len(word), 2), np.int32)
        for k in range(0, len(word), STEP):
            some = slice(k, k + STEP)
            self.postings[some, 0] = place[owner[by_word[some]]]
            self.postings[some, 1] = impact.view(np.int32)[by_word[some]]
        del by_word, owner, impact
        self.df = np.bincount(word, minlength=n_words)
        self.of_word = np.concatenate([[0], np.cumsum(self.df)])
        present = np.flatnonzero(self.df)
        self.most = np.zeros(n_words)
        if len(present):
            self.most[present] = np.maximum.reduceat(self.postings[:, 1].view(np.float32), self.of_word[present])
        # impacts of the common words on every text, and the largest of each block of neighbours
        self.n_blocks = -(-n // NEIGHBOURS)
        common = present[self.df[present] * COMMON >= n]
        common = common[np.argsort(-self.df[common], kind="stable")[:COMMON_WORDS]]
        self.row = np.full(n_words, -1)
        self.row[common] = np.arange(len(common))
        self.common = np.zeros((self.n_blocks * NEIGHBOURS, len(common)), np.float32)
        for k, (a, b) in enumerate(zip(self.of_word[common].tolist(), self.of_word[common + 1].tolist())):
            self.common[self.postings[a:b, 0], k] = self.postings[a:b, 1].view(np.float32)
        self.block_most = np.ascontiguousarray(self.common.reshape(self.n_blocks, NEIGHBOURS, len(common)).max(1).T)
        self.asked = np.zeros(n_words, bool)

    def exact(self, texts: np.ndarray) -> np.ndarray:
        """Full scores of texts for the words asked for, each added up in the order of its words."""
        at = ranges(self.starts[texts], self.ends[texts])
        owner = np.repeat(np.arange(len(texts)), self.ends[texts] - self.starts[texts])
        hit = self.asked[self.word[at]]
        at, owner = at[hit], owner[hit]
        return np.bincount(owner, _impact(self.idf[self.word[at]], self.times[at], self.norm[texts[owner]]), len(texts))

    def search(self, query: np.ndarray, top: int, floor: float = 0.0, last: int = LAST) -> tuple[list, list[float]]:
        """The texts with the ``top`` best scores above 0, best first; none below ``floor``, and of those with just that score none with an id above ``last``.

        Of a tie those with the smallest ids come first.
        """
        return self.search_all([query], top, [floor], [last])[0]

    def search_all(self, queries: list[np.ndarray], top: int, floors: Sequence[float], lasts: Sequence[int]) -> list[tuple[list, list[float]]]:
        """What ``search`` finds for each query."""
        queries = [q[self.df[q] > 0] for q in queries]
        reach = [k for k, q in enumerate(queries) if len(q) and self.most[q].sum() * (1 + SLACK) >= floors[k]]
        found: list[tuple[list, list[float]]] = [([], [])] * len(queries)
        for k, texts in zip(reach, self._candidates([queries[k] for k in reach], [floors[k] for k in reach], top)):
            if not len(texts):
                continue
            self.asked[queries[k]] = True
            scores = self.exact(texts)
            self.asked[queries[k]] = False
            some = (scores > floors[k]) | (scores == floors[k]) & (scores > 0) & (self.number[texts] <= lasts[k])
            texts, scores = texts[some], scores[some]
            best = np.lexsort((self.missing[texts], self.number[texts], -scores))[:top]
            found[k] = [self.ids[x] for x in texts[best].tolist()], scores[best].tolist()
        return found

    def _candidates(self, queries: list[np.ndarray], floors: list[float], top: int) -> Iterator[np.ndarray]:
        """Of each query the texts whose scores can reach the floor or, without one, the ``top`` best."""
        asks = np.zeros((len(queries), len(self.block_most)), np.float32)
        part = np.zeros((len(queries), self.n_blocks * NEIGHBOURS), np.float32)
        for k, query in enumerate(queries):
            row = self.row[query]
            asks[k, row[row >= 0]] = 1
            rare = query[row < 0]
            if len(rare):
                met = np.concatenate([self.postings[a:b] for a, b in zip(self.of_word[rare].tolist(), self.of_word[rare + 1].tolist())])
                part[k] = np.bincount(met[:, 0], met[:, 1].view(np.float32), part.shape[1])
        # the texts that some query can reach with the bounds of their block
        least = np.array(floors, np.float32) * np.float32(1 - SLACK)
        missing = least[:, None] - asks @ self.block_most
        alive = np.zeros((self.n_blocks, NEIGHBOURS), bool)
        for own, rest in zip(part, missing):
            alive |= own.reshape(alive.shape) >= rest[:, None]
        texts = np.flatnonzero(alive.ravel()[: len(self.ids)])
        common = asks @ self.common[texts].T
        for k, own in enumerate(common):
            own += part[k, texts]
            bar = least[k]
            if not floors[k] and len(own) > top:
                bar = np.partition(own, len(own) - top)[len(own) - top] * np.float32(1 - SLACK)
            yield texts[(own >= bar) & (own > 0) if bar <= 0 else own >= bar]


def _impact(idf: np.ndarray, times: np.ndarray, norm: np.ndarray) -> np.ndarray:
    times = times.astype(np.float64)
    return idf * times * (K1 + 1) / (times + norm)


class Asked:
    """The queries of a block, those with the same commonest word side by side, and the weights of the block's words."""

    def __init__(self, ids: np.ndarray, words: list[np.ndarray], df: np.ndarray, idf: np.ndarray):
        commonest = np.array([w[np.argmax(df[w])] for w in words], np.int64)
        order = np.argsort(commonest, kind="stable")
        self.ids, self.idf = ids[order], idf
        self.word = np.concatenate([np.empty(0, np.int32), *(words[k] for k in order.tolist())])
        self.ends = np.cumsum([len(words[k]) for k in order.tolist()], dtype=np.int64)
        self._sorted = np.argsort(self.ids)

    def at(self, ids: np.ndarray) -> np.ndarray:
        """The places of some ids."""
        return self._sorted[np.searchsorted(self.ids, ids, sorter=self._sorted)]

    def words(self, k: int) -> np.ndarray:
        return self.word[self.ends[k - 1] if k else 0 : self.ends[k]]


def _answers(index: DataFrame, held: Broadcast, bars: tuple[np.ndarray, np.ndarray], mean_length: float, top: int) -> DataFrame:
    """(query, doc_id, score): the best texts of every shard for the queries of one block, without those below the query's bar."""
    above = index.sparkSession.sparkContext.broadcast(bars)

    def counted(pieces: list[pa.RecordBatch]) -> tuple[list, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        ids = [x for p in pieces for x in p.column(0).to_pylist()]
        word, times, sizes, lengths = ([] for _ in range(4))
        while pieces:
            piece = pieces.pop(0)
            values, size = _unpacked(piece.column(2))
            word.append(values)
            sizes.append(size)
            times.append(_unpacked(piece.column(3))[0])
            lengths.append(piece.column(1).to_numpy())
        return ids, np.concatenate(word), np.concatenate(times), np.concatenate(sizes), np.concatenate(lengths)

    def answer(pieces: list[pa.RecordBatch], floor: np.ndarray, last: np.ndarray) -> pa.RecordBatch:
        asked = held.value
        shard = Shard.of(*counted(pieces), asked.idf, mean_length)
        rows: tuple[list, list, list] = ([], [], [])
        for start in range(0, len(asked.ids), TOGETHER):
            some = range(start, min(start + TOGETHER, len(asked.ids)))
            found = shard.search_all([asked.words(k) for k in some], top, floor[some.start : some.stop].tolist(), last[some.start : some.stop].tolist())
            for k, (best, scores) in zip(some, found):
                if len(scores) == top:
                    floor[k], last[k] = scores[-1], LAST if best[-1] is None else best[-1]
                rows[0].extend([int(asked.ids[k])] * len(best))
                rows[1].extend(best)
                rows[2].extend(scores)
        return pa.RecordBatch.from_arrays([pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.int64()), pa.array(rows[2], pa.float64())], ["query", "doc_id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        floor, last = (x.copy() for x in above.value)
        pieces: list[pa.RecordBatch] = []
        texts = size = 0
        for piece in chunks(batches):
            pieces.append(piece)
            texts += piece.num_rows
            size += piece.column(2).nbytes // 4
            if texts >= SHARD_TEXTS or size >= SHARD_POSTINGS:
                yield answer(pieces, floor, last)
                texts = size = 0
        if pieces:
            yield answer(pieces, floor, last)

    return index.mapInArrow(run, ANSWERS)


def _shares(n: int) -> list[int]:
    """Of how many texts one is in each sample, the smallest sample, which fills a shard at most, first."""
    shares: list[int] = []
    while n > SHARD_TEXTS * (shares[-1] if shares else 1):
        shares.append(SAMPLE * (shares[-1] if shares else 1))
    return shares[::-1]


def _ranked(answers: DataFrame) -> DataFrame:
    return answers.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))))


def _dealt(index: DataFrame, shards: float) -> DataFrame:
    """The rows of so many shards, a shard in a task."""
    return index.repartition(max(SAMPLE_PARTS, ceil(shards * ROOM)))


def _block(texts: DataFrame, asked: DataFrame, top: int) -> DataFrame:
    """The answers of all texts to the queries of one block, with bars from the samples."""
    context = texts.sparkSession.sparkContext
    asked = asked.where(F.size("words") > 0)
    found = sorted(asked.select(F.explode("words").alias("word")).distinct().toArrow().column(0).to_pylist())
    if not found:
        return texts.sparkSession.createDataFrame([], ANSWERS)
    vocabulary = context.broadcast({w: k for k, w in enumerate(found)})

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in chunks(batches):
            own = [[vocabulary.value[w] for w in x] for x in piece.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(own, pa.list_(pa.int32()))], ["query", "words"])

    rows = asked.mapInArrow(number, "query long, words array<int>").toArrow()
    own = rows.column(1).combine_chunks()
    ends, flat = np.cumsum(own.value_lengths().to_numpy()), own.flatten().to_numpy()
    ids, owner = np.unique(rows.column(0).to_numpy(), return_inverse=True)
    same = np.split(np.argsort(owner, kind="stable"), np.cumsum(np.bincount(owner))[:-1])
    merged = [np.unique(np.concatenate([flat[ends[k - 1] if k else 0 : ends[k]] for k in some])) for some in same]

    index = stored(indexed(texts, vocabulary))
    size = index.agg(F.count("*").alias("n"), F.sum("length").alias("length"), F.sum(F.octet_length("words")).alias("bytes")).first()
    n, mean_length = size.n, size.length / size.n if size.n else 0.0
    df = document_frequencies(index, len(found))
    idf = np.array([log(1 + (n - k + 0.5) / (k + 0.5)) for k in df.tolist()])
    block = Asked(ids, merged, df, idf)
    held = context.broadcast(block)

    met = index.where(F.octet_length("words") > 0)
    shards = max(n / SHARD_TEXTS, (size.bytes or 0) / 4 / SHARD_POSTINGS)
    floor, last = np.zeros(len(ids)), np.full(len(ids), LAST)
    for share in _shares(n):
        sample = _dealt(met.where(F.pmod(F.xxhash64("doc_id"), F.lit(share)) == 0), shards / share)
        bars = _ranked(_answers(sample, held, (floor, last), mean_length, top)).where(F.col("rank") == top).toArrow()
        at = block.at(bars.column("query").to_numpy())
        floor[at], last[at] = bars.column("score").to_numpy(), bars.column("doc_id").fill_null(int(LAST)).to_numpy()
    return _answers(_dealt(met, shards), held, (floor, last), mean_length, top)


def search(docs: DataFrame, queries: DataFrame, top: int = TOP, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(query_id, rank, doc_id, score): for every row of ``queries`` the ``top`` rows of ``docs`` with the best BM25 scores.

    A query is the set of a text's words. Scores are above 0; ties go to the smallest doc_id, a missing one last. Repeated rows of ``docs`` are
    ranked each; queries with the same id are one, with the words of all. Null and empty texts are found by nothing and find nothing.
    """
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in chunks(batches):
            own = [sorted(set(words(t))) for t in strings(piece.column(1))]
            yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(own, pa.list_(pa.string()))], ["query", "words"])

    asked = stored(queries.select(F.col(doc_id).cast("long").alias("query"), F.col(text).alias("text")).where("query is not null").mapInArrow(split, "query long, words array<string>"))
    blocks = -(-(asked.agg(F.sum(F.size("words")).alias("n")).first().n or 0) // QUERY_WORDS)
    parts = [_block(texts, asked.where(F.pmod(F.xxhash64("query"), F.lit(blocks)) == k), top) for k in range(blocks)]
    best = reduce(DataFrame.unionByName, parts) if parts else docs.sparkSession.createDataFrame([], ANSWERS)
    return _ranked(best).where(F.col("rank") <= top).select(F.col("query").alias("query_id"), "rank", "doc_id", "score")
