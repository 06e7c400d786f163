"""Log-probabilities of texts: a log-bilinear model over a smoothed unigram base, trained in numpy by noise contrast.

The base is the share of each word in all training tokens, 0.1 added to every count. Every word also belongs to a unit:
the most frequent ones are units of their own, the others share one by how they begin and end. Within the shared units
the more frequent words are members, with vectors of their own as context and as outcome; their number grows with the
root of the training tokens, and that of the shared units with the cube root of the members. The items of a unit are its
members and one for all its other words. The most frequent ones are groups of their own, the others stand in groups of
neighbours in the alphabet, about as many as a group has items.
The model predicts a token from the ``CONTEXT`` tokens before it: the vectors of these, each through the matrix of its
distance, add up to a prediction. Its product with the vectors of all units gives normalised probabilities of the unit, that
with the vectors of the unit's groups those of the group, and that with the vectors of the group's items those within it.
The probability of a word is the product of the three; words that are no members share theirs as in the base. So a text's
score is its base score plus, for each token, what the context adds about the unit, the group and the member.

Training starts on the driver from a draw of spans of the texts, bounded in tokens; then every partition of all training
texts trains a copy on all its tokens, and Spark averages the copies row by row, weighted by how often each trained the
row. Counts of words are exact and cover all training texts. Counts of the most frequent words and of the members are broadcast; the others meet the
counts in a shuffle join, a row for each word of a text.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from math import log10

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paceforge.llm.common import chunks, stored, strings

ADDED = 0.1
#: The token after the last word; no word holds a space.
END = b" "
#: Words that are units of their own, units that the others share at least, context tokens and length of vectors.
OWN_UNITS, SHARED_UNITS, CONTEXT, WIDTH = 128, 128, 3, 16
#: Members for the root of the training tokens, and least count of one.
MEMBERS, LEAST_COUNT = 8, 5
#: Items up to which each of a unit is a group of its own.
FLAT = 16
#: Words whose counts are broadcast, at most or as many as there are members.
HOT_WORDS = 60_000
#: Tokens drawn for the start, about, in spans of so many characters at most, and how often they are gone through.
START_TOKENS, SPAN, START_ROUNDS = 320_000, 4_000, 6
#: Tokens of a step of training and of scoring, noise units of a step, noise members of a token, and rates of learning.
STEP, SCORED, NOISE, INNER_NOISE, START_RATE, RATE = 1_024, 8_192, 32, 4, 0.1, 0.05
#: Tickets of an item in the draw of inner noise, on average; scores of a block of products, which stays in a core's cache.
TICKETS, BLOCK = 8, 1 << 17
SEED = 7
#: Words whose unit a worker remembers.
REMEMBERED = 300_000


def words(text: str) -> list[bytes]:
    """Words of a text in lower case (A-Z only), between blanks \\x20 and \\x09-\\x0D."""
    return text.encode().lower().split()


def word_codes(column: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct words of a column of texts and the end, which of them every token is, and how many tokens each text has.

    They are the words of ``words``, with an end after each text; a missing text is an empty one.
    """
    parts = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(column, "")))
    coded = pc.dictionary_encode(parts.flatten())
    known, codes = coded.dictionary.cast(pa.binary()), coded.indices.to_numpy()
    size = pc.list_value_length(parts).to_numpy().astype(np.int64)
    # blanks before the first and after the last word leave empty strings
    full = codes != pc.index(known, pa.scalar(b"", pa.binary())).as_py()
    if not full.all():
        size -= np.bincount(np.repeat(np.arange(len(size)), size)[~full], minlength=len(size))
        codes = codes[full]
    size += 1
    out, word = np.full(len(codes) + len(size), len(known), np.int64), np.ones(len(codes) + len(size), bool)
    word[np.cumsum(size) - 1] = False
    out[word] = codes
    return pa.concat_arrays([known, pa.array([END], pa.binary())]), out, size


def shared_unit(word: bytes, shared: int = SHARED_UNITS) -> int:
    """Unit of a word that has none of its own, by its first letter and its last two."""
    if word == END:
        return 0
    bare = word.strip(b".,;:!?") or word
    return OWN_UNITS + zlib.crc32(bare[:1] + bare[-2:]) % shared


class Units(dict):
    """Number of every word, of its own or of its unit; 0 is the end, the last number is what stands before a text."""

    def __init__(self, own: dict[bytes, int], shared: int = SHARED_UNITS):
        super().__init__(own)
        self.shared, self.most = shared, len(own) + REMEMBERED

    def __missing__(self, word: bytes) -> int:
        found = shared_unit(word, self.shared)
        if len(self) < self.most:
            self[word] = found
        return found


class Numbers:
    """The numbers of whole columns of words, as ``Units`` has them word by word."""

    def __init__(self, own: dict[bytes, int], shared: int):
        self.words, self.numbers, self.shared = pa.array(list(own), pa.binary()), np.array(list(own.values()), np.int32), shared

    def of(self, words: pa.Array) -> np.ndarray:
        at = pc.index_in(words, value_set=self.words).fill_null(-1).to_numpy()
        found, rare = self.numbers[at], at < 0
        word = words.filter(pa.array(rare)).cast(pa.string())
        bare = pc.ascii_trim(word, ".,;:!?")
        bare = pc.if_else(pc.equal(pc.binary_length(bare), 0), word, bare).cast(pa.binary())
        ends = pc.dictionary_encode(pc.binary_join_element_wise(pc.binary_slice(bare, 0, 1), pc.binary_slice(bare, -2), b""))
        unit = np.array([OWN_UNITS + zlib.crc32(x) % self.shared for x in ends.dictionary.to_pylist()], np.int32)
        found[rare] = unit[ends.indices.to_numpy()]
        return found


def word_counts(texts: DataFrame) -> DataFrame:
    """(word binary, n) of all tokens of a column of texts, ends included; a null text is an empty one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in chunks(batches):
            known, codes, _ = word_codes(piece.column(0))
            times = np.bincount(codes, minlength=len(known))
            some = np.flatnonzero(times)
            yield pa.RecordBatch.from_arrays([known.take(pa.array(some)), pa.array(times[some])], ["word", "n"])

    return texts.mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Inner:
    """The items of the shared units: all other words of a unit as one, and its members; unit by unit, in groups."""

    def __init__(self, units: int, shared: int, member_unit: np.ndarray, mass: np.ndarray):
        """member_unit: unit of every member, in rising order; mass: counts of the numbers (units, then members)."""
        first = units - shared
        size = 1 + np.bincount(member_unit - first, minlength=shared) if shared else np.empty(0, np.int64)
        self.starts = np.cumsum([0, *size]).astype(np.int64)
        unit = self.unit_of_item = np.repeat(np.arange(shared), size)
        number = np.empty(len(unit), np.int64)  # of each item: at first the other words, then the members as they come
        number[self.starts[:-1]] = np.arange(first, units)
        at = np.arange(len(member_unit)) + member_unit - first + 1
        number[at] = np.arange(units, units + len(member_unit))
        place = np.arange(len(unit)) - self.starts[unit]
        often = np.lexsort((-mass[number], place > 0, unit))
        rank = np.empty_like(place)
        rank[often] = place
        alone = np.where(size <= FLAT, size, 1 + 2 * np.sqrt(size).astype(np.int64))
        rest = size - alone
        groups = np.sqrt(rest).astype(np.int64)
        order = np.lexsort((place, rank >= alone[unit], unit))
        number = number[order]
        #: Unit of every number, and its item; -1 where there is nothing to tell apart.
        self.unit_of = np.concatenate([np.arange(units), member_unit]).astype(np.int64)
        self.item_of = np.full(len(self.unit_of), -1, np.int64)
        self.item_of[number] = np.where(size[unit] > 1, np.arange(len(unit)), -1)
        #: Where the groups of each unit start, the unit and the first item of each group, and the group of each item.
        self.group_starts = np.cumsum([0, *(alone + groups)]).astype(np.int64)
        self.unit_of_group = np.repeat(np.arange(shared), alone + groups)
        after = place - alone[unit]
        self.group_of_item = self.group_starts[unit] + np.where(after < 0, place, alone[unit] + after * groups[unit] // np.maximum(rest, 1)[unit])
        self.item_starts = np.searchsorted(self.group_of_item, np.arange(self.group_starts[-1] + 1))
        held = mass[number]
        whole, grouped = np.bincount(unit, held, shared), np.bincount(self.group_of_item, held, self.group_starts[-1])
        #: log10 share of each item in its unit, of each group in its unit, and of each item in its group.
        self.share = np.log10(held / whole[unit])
        self.group_share = np.log10(grouped / whole[self.unit_of_group])
        self.item_share = np.log10(held / grouped[self.group_of_item])


class Level:
    """Rows in runs, a run for each row of the level above, and the noise that is drawn from them.

    A row has tickets in proportion to its share of the run, rounded, one at the least; noise is the row of a ticket.
    """

    def __init__(self, share: np.ndarray, starts: np.ndarray):
        size = np.diff(starts)
        run = np.repeat(np.arange(len(size)), size)
        held = np.maximum(1, np.rint(10.0**share * size[run] * TICKETS)).astype(np.int64)
        self.starts, self.many = starts, size > 1
        self.tickets = np.repeat(np.arange(len(share), dtype=np.int32), held)
        self.count = np.bincount(run, held, len(size)).astype(np.int64)
        self.first = np.cumsum(self.count) - self.count
        #: Logarithm of how often a row is drawn for a token of its run.
        self.odds = np.log(INNER_NOISE * held / self.count[run]).astype(np.float32)

    def draw(self, runs: np.ndarray, rng: np.random.Generator) -> np.ndarray:
        """Noise for tokens of these runs."""
        at = (rng.random((len(runs), INNER_NOISE)) * self.count[runs][:, None]).astype(np.int64)
        return self.tickets[self.first[runs][:, None] + at]


@dataclass
class Base:
    """The unigram side: counts as a table, totals, the hot counts, units with their log10 share, and members within the units.

    ``own`` numbers the words with vectors of their own: units first, then (after all units) the members, unit by unit.
    """

    counts: DataFrame
    tokens: int
    distinct: int
    hot: dict[bytes, int]
    least: int
    own: dict[bytes, int]
    share: np.ndarray
    shared: int
    inner: Inner

    @property
    def total(self) -> float:
        return self.tokens + ADDED * (self.distinct + 1)


def base(texts: DataFrame) -> Base:
    """The unigram side of a column of training texts."""
    counts = stored(word_counts(texts))
    size = counts.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    tokens, distinct = size.n or 0, size.v
    # counts from which on the words fit a bound, from a histogram of a few hundred rows
    bucket = F.floor(F.log2("n") * 8)
    steps = counts.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("w"), F.min("n").alias("low")).orderBy(F.desc("bucket")).collect()

    def least_of(bound: int) -> int:
        least = tokens + 1
        for row in steps:
            bound -= row.w
            if bound < 0:
                break
            least = row.low
        return least

    # the members: frequent words after the units of their own; their counts are broadcast in any case
    often = max(LEAST_COUNT, least_of(OWN_UNITS + int(MEMBERS * tokens**0.5)))
    least = min(least_of(HOT_WORDS), often)
    hot = {bytes(r.word): r.n for r in counts.where(F.col("n") >= least).collect()}
    top = [w for w in sorted(hot, key=lambda w: (-hot[w], w)) if w != END][: OWN_UNITS - 1]
    own = {END: 0} | {w: k + 1 for k, w in enumerate(top)}
    members = [w for w, n in hot.items() if n >= often and w not in own]
    shared = max(SHARED_UNITS, int(len(members) ** (1 / 3)))
    size = OWN_UNITS + shared
    members.sort(key=lambda w: (shared_unit(w, shared), w))
    member_unit = np.array([shared_unit(w, shared) for w in members], np.int64)
    own |= {w: size + k for k, w in enumerate(members)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size + len(members))
        for batch in batches:
            which = held.value.of(batch.column(0))
            total += np.bincount(which, batch.column(1).to_numpy() + ADDED, len(total))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["unit", "mass"])

    held = texts.sparkSession.sparkContext.broadcast(Numbers(own, shared))
    mass = np.zeros(size + len(members))
    mass[:size] = ADDED  # what no training text has, in every unit
    found = counts.mapInArrow(run, "unit long, mass double").groupBy("unit").agg(F.sum("mass").alias("mass")).toArrow()
    mass[found.column(0).to_numpy()] += found.column(1).to_numpy()
    inner = Inner(size, shared, member_unit, mass)
    whole = np.bincount(inner.unit_of, mass, size)
    return Base(counts, tokens, distinct, hot, least, own, np.log10(whole / (tokens + ADDED * (distinct + 1))), shared, inner)


class LogBilinear:
    """Vectors of units and members as context and as outcome, and of groups as outcome, a matrix for each distance, and biases."""

    def __init__(self, share: np.ndarray, inner: Inner | None = None):
        rng = np.random.default_rng(SEED)
        self.units = len(share)
        self.inner = inner or Inner(self.units, 0, np.empty(0, np.int64), np.zeros(self.units))
        self.numbers = len(self.inner.unit_of)
        noise = 10.0**share
        self.noise = noise / noise.sum()
        self.ends = np.cumsum(self.noise)[:-1]
        #: Groups, and after them the items: a run for each unit, and one for each group.
        group = len(self.inner.group_share)
        starts = np.concatenate([self.inner.group_starts, group + self.inner.item_starts[1:]])
        inner = np.concatenate([self.inner.group_share, self.inner.item_share])
        self.nodes = Level(inner, starts)
        units = rng.normal(0, 0.1, (self.units + 1, WIDTH)).astype(np.float32)
        self.context = units[np.append(self.inner.unit_of, self.units)]  # a member starts as its unit
        self.matrix = np.stack([np.eye(WIDTH, dtype=np.float32) / (k + 1) for k in range(CONTEXT)])
        self.outcome = np.zeros((self.units, WIDTH), np.float32)
        self.bias = np.log(self.noise).astype(np.float32)
        self.node = np.zeros((len(inner), WIDTH), np.float32)
        self.node_bias = (inner * np.log(10)).astype(np.float32)
        #: How often each row of context, outcome and node was trained.
        self.trained = [np.zeros(len(p)) for p in (self.context, self.outcome, self.node)]
        self._place = np.zeros(max(len(x) for x in self.trained), np.int64)

    @property
    def item(self) -> np.ndarray:
        """The vectors of the items."""
        return self.node[len(self.inner.group_share) :]

    def parameters(self) -> list[np.ndarray]:
        return [self.context, self.matrix, self.outcome, self.bias, self.node, self.node_bias]

    def rows(self) -> np.ndarray:
        """All parameters as rows of a vector and a bias: context, outcome, node, matrix."""
        vectors = np.concatenate([self.context, self.outcome, self.node, self.matrix.reshape(-1, WIDTH)])
        bias = np.concatenate([np.zeros(len(self.context)), self.bias, self.node_bias, np.zeros(CONTEXT * WIDTH)])
        return np.column_stack([vectors, bias]).astype(np.float64)

    def load(self, rows: np.ndarray) -> None:
        at = 0
        for p, bias in ((self.context, None), (self.outcome, self.bias), (self.node, self.node_bias), (self.matrix.reshape(-1, WIDTH), None)):
            p[...] = rows[at : at + len(p), :WIDTH]
            if bias is not None:
                bias[...] = rows[at : at + len(p), WIDTH]
            at += len(p)

    def before(self, rows: Iterable[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Contexts and outcomes of rows of units, each row a text of its own."""
        pad = np.full(CONTEXT, self.numbers, np.int32)
        rows = list(rows)
        flat = np.concatenate([x for r in rows for x in (pad, r)]) if rows else pad
        own = np.ones(len(flat), bool)
        starts = np.cumsum([0, *(CONTEXT + len(r) for r in rows)])[:-1]
        own[(starts[:, None] + np.arange(CONTEXT)).ravel().astype(np.int64)] = False
        at = np.flatnonzero(own) if rows else np.empty(0, np.int64)
        return np.stack([flat[at - k - 1] for k in range(CONTEXT)], axis=1), flat[at]

    def train(self, contexts: np.ndarray, outcomes: np.ndarray, rate: float, rng: np.random.Generator, sums: list[np.ndarray]) -> None:
        """One pass of noise-contrastive steps; ``sums`` holds the squares of past gradients."""
        odds = np.log(NOISE * self.noise).astype(np.float32)
        units = self.inner.unit_of[outcomes]
        steps = -(-len(outcomes) // STEP)
        noise = np.searchsorted(self.ends, rng.random((steps, NOISE)), side="right")
        # below the unit: the node of each token, and nodes drawn by their share, step by step
        tokens, node, run = self._path(self.inner.item_of[outcomes])
        order = np.argsort(_short(tokens // STEP, steps), kind="stable")
        tokens, drawn = tokens[order], np.concatenate([node[:, None], self.nodes.draw(run, rng)], axis=1)[order]
        cuts = np.searchsorted(tokens, np.arange(steps + 1) * STEP)
        for table, rows in ((0, [contexts]), (1, [units, noise]), (2, [drawn])):
            for x in rows:
                self.trained[table] += np.bincount(x.ravel(), minlength=len(self.trained[table]))
        for n, at, low, high in zip(noise, range(0, len(outcomes), STEP), cuts[:-1], cuts[1:], strict=True):
            c, u = contexts[at : at + STEP], units[at : at + STEP]
            size = len(u)
            used, where = self._distinct(c.T.ravel())
            seen, where = self.context.take(used, axis=0), where.reshape(CONTEXT, size)
            h = sum((seen @ self.matrix[k]).take(where[k], axis=0) for k in range(CONTEXT))
            q, qn = self.outcome.take(u, axis=0), self.outcome[n]
            own = np.einsum("bd,bd->b", h, q) + (self.bias - odds)[u]
            other = h @ qn.T + (self.bias[n] - odds[n])
            g, gn = _sigmoid(-own), -_sigmoid(other)  # g: one minus the chance that the token is data
            dh = g[:, None] * q + gn @ qn
            # the same within the unit and the group
            if high > low:
                inside, some = tokens[low:high] - at, drawn[low:high]
                hi = h.take(inside, axis=0)
                qi = self.node.take(some, axis=0)
                gi = -_sigmoid(np.einsum("bd,bkd->bk", hi, qi) + self.node_bias.take(some) - self.nodes.odds.take(some))
                gi[:, 0] += 1
                dh += _scattered(inside, np.einsum("bk,bkd->bd", gi, qi), size)
                self._learn(4, sums, some.ravel(), (gi[:, :, None] * hi[:, None, :]).reshape(-1, WIDTH), gi.ravel(), rate, size)
            met = [_scattered(where[k], dh, len(used)) for k in range(CONTEXT)]
            moved = np.stack([seen.T @ x for x in met]) / size
            self._step(0, sums, used, sum(x @ self.matrix[k].T for k, x in enumerate(met)), None, rate, size)
            self._learn(2, sums, np.concatenate([u, n]), np.concatenate([g[:, None] * h, gn.T @ h]), np.concatenate([g, gn.sum(axis=0)]), rate, size)
            sums[1] += moved * moved
            self.matrix += rate * moved / np.sqrt(sums[1] + 1e-8)

    def _path(self, items: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Tokens, nodes and runs of all steps below the unit to these items, as far as there is something to tell apart."""
        inside = np.flatnonzero(items >= 0)
        items = items[inside]
        groups = self.inner.group_of_item[items]
        node, run = np.concatenate([groups, items + len(self.inner.group_share)]), np.concatenate([self.inner.unit_of_group[groups], groups + len(self.inner.group_starts) - 1])
        many = self.nodes.many[run]
        return np.concatenate([inside, inside])[many], node[many], run[many]

    def _distinct(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The distinct row numbers, and which of them each one is; without a sort."""
        every = np.arange(len(rows))
        self._place[rows] = every
        used = rows[self._place[rows] == every]
        self._place[used] = every[: len(used)]
        return used, self._place[rows]

    def _learn(self, at: int, sums: list[np.ndarray], rows: np.ndarray, values: np.ndarray, bias: np.ndarray, rate: float, size: int) -> None:
        """A step of the parameter number ``at`` and of the bias after it in the rows that have a gradient."""
        used, where = self._distinct(rows)
        self._step(at, sums, used, _scattered(where, values, len(used)), np.bincount(where, bias, len(used)).astype(np.float32), rate, size)

    def _step(self, at: int, sums: list[np.ndarray], used: np.ndarray, grad: np.ndarray, bias: np.ndarray | None, rate: float, size: int) -> None:
        """The same for distinct rows, each with its whole gradient."""
        for k, x in enumerate((grad, bias)):
            if x is not None:
                held, past = self.parameters()[at + k], sums[at + k].take(used, axis=0)
                x /= np.float32(size)
                past += x * x
                _put(sums[at + k], used, past)
                past += np.float32(1e-8)
                x /= np.sqrt(past, out=past)
                x *= np.float32(rate)
                x += held.take(used, axis=0)
                _put(held, used, x)

    def log10(self, contexts: np.ndarray, outcomes: np.ndarray) -> np.ndarray:
        """Normalised log10 probability of every outcome, in batches of matrix products; for a word that is no member,
        that of all such words of its unit."""
        moved = [_with_one(self.context @ self.matrix[k], float(k == 0)) for k in range(CONTEXT)]
        outcome, nodes = (np.concatenate([v.T, b[None]]) for v, b in ((self.outcome, self.bias), (self.node, self.node_bias)))
        longest = sum(_longest(x[:, :-1]) for x in moved)
        units, items = self.inner.unit_of[outcomes], self.inner.item_of[outcomes]
        out = np.empty(len(outcomes), np.float64)
        h = np.empty((len(outcomes), WIDTH + 1), np.float32)
        for at in range(0, len(outcomes), SCORED):
            c = contexts[at : at + SCORED]
            part = moved[0].take(c[:, 0], axis=0)
            for k in range(1, CONTEXT):
                part += moved[k].take(c[:, k], axis=0)
            h[at : at + SCORED] = part
            out[at : at + SCORED] = _own_log(part, outcome, units[at : at + SCORED], longest * _longest(self.outcome))
        # run by run what the nodes add
        tokens, node, run = self._path(items)
        order = np.argsort(_short(run, len(self.nodes.many)), kind="stable")
        tokens, node, run = tokens[order], node[order], run[order]
        h, added = h.take(tokens, axis=0), np.empty(len(run))
        reach = longest * _longest(self.node)
        cuts = np.flatnonzero(np.diff(run, prepend=-1, append=-1)).tolist() if len(run) else [0]
        for at, end in zip(cuts[:-1], cuts[1:], strict=True):
            low, high = self.nodes.starts[run[at]], self.nodes.starts[run[at] + 1]
            added[at:end] = _own_log(h[at:end], nodes[:, low:high], node[at:end] - low, reach)
        out += np.bincount(tokens, added, len(out))
        return out / np.log(10)


def _with_one(vectors: np.ndarray, one: float) -> np.ndarray:
    """Vectors with one more entry, which a bias is multiplied with."""
    return np.column_stack([vectors, np.full(len(vectors), one, vectors.dtype)])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    x = np.negative(x)
    with np.errstate(over="ignore"):  # one over infinity is zero
        np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def _short(x: np.ndarray, bound: int) -> np.ndarray:
    """Whole numbers below ``bound`` in two bytes if they fit, which sort faster."""
    return x.astype(np.uint16) if bound <= 1 << 16 else x


def _longest(vectors: np.ndarray) -> float:
    """Length of the longest vector."""
    return float(np.sqrt(np.einsum("bd,bd->b", vectors, vectors).max(initial=0)))


def _own_log(h: np.ndarray, vectors: np.ndarray, own: np.ndarray, reach: float) -> np.ndarray:
    """Normalised log probability of its own column for every prediction; the last entries are one and the biases.

    No score is farther than ``reach`` from its bias.
    """
    out, ones = np.empty(len(own), np.float64), np.ones(vectors.shape[1], np.float32)
    small = reach + abs(vectors[-1].max()) < 80
    step = max(1, BLOCK // len(ones))
    for at in range(0, len(own), step):
        s = h[at : at + step] @ vectors
        if not small:
            s -= s.max(axis=1, keepdims=True)
        mine = s[np.arange(len(s)), own[at : at + step]]
        out[at : at + step] = mine - np.log(np.exp(s, out=s) @ ones)
    return out


def _scattered(rows: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sum of the value rows by row number; two entries are added at a time, as a complex number."""
    cells = (rows[:, None] * (WIDTH // 2) + np.arange(WIDTH // 2)).ravel()
    out = np.zeros(n * (WIDTH // 2), np.complex64)
    np.add.at(out, cells, values.astype(np.float32, copy=False).ravel().view(np.complex64))
    return out.view(np.float32).reshape(n, WIDTH)


def _put(table: np.ndarray, rows: np.ndarray, values: np.ndarray) -> None:
    """table[rows] = values, each row in one piece."""
    if table.ndim == 1:
        table[rows] = values
    else:
        whole = f"V{table.itemsize * table.shape[1]}"
        table.view(whole)[:, 0][rows] = np.ascontiguousarray(values).view(whole)[:, 0]


def drawn_spans(text: str, part: float) -> Iterator[list[bytes]]:
    """Words of about this part of a text's spans, drawn by a hash of the text, so that copies draw the same; the end is
    with the last span, and words that a cut goes through are left out."""
    key = xxhash.xxh64_intdigest(text)
    for at in range(0, max(1, len(text)), SPAN):
        if xxhash.xxh32_intdigest(at.to_bytes(8), key % (1 << 32)) < part * (1 << 32):
            span, last = text[at : at + SPAN], at + SPAN >= len(text)
            found = words(span)
            yield found[bool(at) and not span[0].isspace() : None if last or span[-1].isspace() else -1] + [END] * last


def _unit_rows(texts: pa.Array, numbers: Numbers) -> list[np.ndarray]:
    known, codes, size = word_codes(texts)
    return np.split(numbers.of(known)[codes], np.cumsum(size)[:-1])


def _sums(model: LogBilinear, start: float) -> list[np.ndarray]:
    return [np.full(p.shape, start, np.float32) for p in model.parameters()]


def train(texts: DataFrame, known: Base) -> LogBilinear:
    """A model from a column of training texts and their base."""
    model = LogBilinear(known.share, known.inner)
    if not known.tokens:
        return model
    words_held = texts.sparkSession.sparkContext.broadcast(known.own)
    shared = known.shared

    part = min(1.0, START_TOKENS / known.tokens)

    def numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit = Units(words_held.value, shared)
        for piece in chunks(batches):
            drawn = [[unit[w] for w in span] for t in strings(piece.column(0)) for span in drawn_spans(t, part)]
            yield pa.RecordBatch.from_arrays([pa.array(drawn, pa.list_(pa.int32()))], ["units"])

    # copies count once, so the draw is bounded whatever is repeated, and by spans however long a text is
    start = sorted(r.units for r in texts.mapInArrow(numbers, "units array<int>").distinct().collect())
    rng = np.random.default_rng(SEED)
    sums = _sums(model, 0.0)
    for _ in range(START_ROUNDS):
        order = rng.permutation(len(start))
        model.train(*model.before(np.array(start[k], np.int32) for k in order), START_RATE, rng, sums)

    model.trained = [np.zeros(len(x)) for x in model.trained]
    held = texts.sparkSession.sparkContext.broadcast((model, sums, Numbers(known.own, shared)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        copy, past = pickle.loads(pickle.dumps(held.value[:2]))  # a worker's broadcast value serves its next task as well
        unit, rng, tokens = held.value[2], np.random.default_rng(SEED + 1), 0
        for piece in chunks(batches):
            contexts, outcomes = copy.before(_unit_rows(piece.column(0), unit))
            copy.train(contexts, outcomes, RATE, rng, past)
            tokens += len(outcomes)
        weight = np.concatenate([*copy.trained, np.full(CONTEXT * WIDTH, float(tokens))])
        some = np.flatnonzero(weight)
        rows = copy.rows()[some] * weight[some, None]
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(weight[some]), *map(pa.array, np.ascontiguousarray(rows.T))], ["row", "weight", *names])

    names = [f"v{k}" for k in range(WIDTH + 1)]
    copies = texts.mapInArrow(run, ", ".join(["row long", "weight double", *(f"{x} double" for x in names)]))
    summed = copies.groupBy("row").agg(*(F.sum(x).alias(x) for x in ("weight", *names))).toArrow()
    flat, at = model.rows(), summed.column(0).to_numpy()
    flat[at] = np.column_stack([summed.column(k + 2).to_numpy() for k in range(WIDTH + 1)]) / summed.column(1).to_numpy()[:, None]
    model.load(flat)
    return model


def score(docs: DataFrame, training: Column, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) of every row of ``docs``, learned from the rows where ``training``.

    A null text counts as empty: its end is its only token. Repeated rows are all returned. Without training texts
    every token has the base's one probability, and score is base_score.
    """
    texts = docs.where(training).select(text)
    known = base(texts)
    model = train(texts, known)
    spark = docs.sparkSession
    hot = pa.array(list(known.hot), pa.binary()), np.array([*(log10((n + ADDED) / known.total) for n in known.hot.values()), np.nan])
    held = spark.sparkContext.broadcast((model, Numbers(known.own, known.shared), *hot, known.share))
    kind = dict(docs.select(doc_id).dtypes)[doc_id]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, part = 0, TaskContext.get().partitionId() << 40
        for piece in chunks(batches):
            yield _scored(piece, *held.value, part + rows)
            rows += piece.num_rows

    schema = f"row long, doc_id {kind}, n_tokens long, hot_known long, hot_base double, gain double, tail array<struct<word: binary, n: int>>"
    # the numbers of rows are fixed by this table; nothing after it runs the scoring again
    first = stored(docs.select(doc_id, text).mapInArrow(run, schema))
    tail = first.select("row", F.explode("tail").alias("t")).select("row", F.col("t.word").alias("word"), F.col("t.n").alias("times"))
    rare = known.counts.where(F.col("n") < known.least)
    met = tail.join(rare, "word", "left")
    share = F.log10((F.coalesce("n", F.lit(0)) + F.lit(ADDED)) / F.lit(known.total))
    sums = met.groupBy("row").agg(F.sum(F.col("times") * share).alias("tail_base"), F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("tail_known"))
    both = first.drop("tail").join(sums, "row", "left")
    base_score = F.col("hot_base") + F.coalesce("tail_base", F.lit(0.0))
    return both.select(
        "doc_id",
        "n_tokens",
        (F.col("hot_known") + F.coalesce("tail_known", F.lit(0))).alias("n_known"),
        F.lit(known.tokens).cast("long").alias("train_tokens"),
        base_score.alias("base_score"),
        (base_score + F.col("gain")).alias("score"),
    )


def _scored(piece: pa.RecordBatch, model: LogBilinear, numbers: Numbers, hot: pa.Array, based_hot: np.ndarray, share: np.ndarray, first: int) -> pa.RecordBatch:
    """What a piece of texts gets without a join: tokens, hot words, what the contexts add, and the words left over."""
    found, codes, size = word_codes(piece.column(1))
    p = based_hot[pc.index_in(found, value_set=hot).fill_null(-1).to_numpy()][codes]
    text, rare = np.repeat(np.arange(len(size)), size), np.isnan(p)
    known = np.bincount(text[~rare], minlength=len(size))
    based = np.bincount(text, np.where(rare, 0.0, p), len(size))
    tail, times = np.unique(text[rare] * len(found) + codes[rare], return_counts=True)
    units = np.split(numbers.of(found)[codes], np.cumsum(size)[:-1])
    contexts, outcomes = model.before(units)
    items = model.inner.item_of[outcomes]
    added = model.log10(contexts, outcomes) - share[model.inner.unit_of[outcomes]]
    added[items >= 0] -= model.inner.share[items[items >= 0]]
    gain = np.add.reduceat(added, np.cumsum(size) - size)
    pairs = pa.StructArray.from_arrays([found.take(pa.array(tail % len(found))), pa.array(times, pa.int32())], ["word", "n"])
    ends = pa.array(np.searchsorted(tail, np.arange(len(size) + 1) * len(found)), pa.int32())
    columns = [
        pa.array(np.arange(first, first + len(size), dtype=np.int64)),
        piece.column(0),
        pa.array(size),
        pa.array(known, pa.int64()),
        pa.array(based, pa.float64()),
        pa.array(gain, pa.float64()),
        pa.ListArray.from_arrays(ends, pairs),
    ]
    return pa.RecordBatch.from_arrays(columns, ["row", "doc_id", "n_tokens", "hot_known", "hot_base", "gain", "tail"])
