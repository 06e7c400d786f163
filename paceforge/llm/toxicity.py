"""Toxicity of texts: a support vector machine on a subsequence string kernel with Nystroem landmarks.

Strings are compared by the subsequences of ``ORDER`` characters that they share, each weighed down by the
stretch it takes up in both, so an insult with gaps or inserted characters stays near the plain one. Landmarks
are character runs of words that toxic training texts share and clean ones hardly have, until every toxic text that shares any has
one, and the clean words that come nearest to them. A word's features are its normalised kernel values with the landmarks above ``FLOOR``;
the machine's ridge is that of the kernel's space, by the landmarks' own kernel matrix (Nystroem).
A sentence is as toxic as its worst word, and a text as its worst sentence: of each toxic training text the worst
word is the example (with copies that are gapped), of clean ones every word is. The largest value of a text, through
a logistic curve, is its score.

The kernel runs over pairs of a word and a landmark. A pair is left out only when the letters they share bound its
value by the floor, so nothing is lost by it.
"""

from __future__ import annotations

import re
from array import array
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from itertools import chain
from sys import intern

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paceforge.llm.common import chunks, strings

ORDER, DECAY, FLOOR = 3, 0.7, 0.4
#: Toxic runs that are landmarks by their number of texts alone, if it is a hundredth of all (more follow until no text is
#: without one), clean words that are landmarks for sure, and the length of runs.
TOXIC_LANDMARKS, CLEAN_LANDMARKS, RUNS = 64, 24, (4, 10)
#: Part of the runs of a support that may be there by chance, as clean texts show.
CHANCE = 0.1
#: Labelled texts drawn of each class.
TOXIC_TEXTS, CLEAN_TEXTS = 1_500, 3_000
#: Weight of clean texts against toxic ones in the machine, and of a clean text that is flagged against a toxic one that is missed.
CLEAN_WEIGHT, FALSE_ALARM = 4.0, 3.0
#: Longest string compared at once; longer ones are cut into windows that overlap by half.
WINDOW = 24
#: Words whose value a worker remembers, and the longest of them.
REMEMBERED, REMEMBERED_LENGTH = 400_000, 64
SPELLED = re.compile(r"(?<!\S)\S(?:\s\S){3,}(?!\S)")
EDGE = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "«»“”„‘’…¿¡"


def units(text: str) -> set[str]:
    """Words of a text in lower case; letters that stand apart also as one word."""
    lower = text.lower()
    found = set(lower.split())
    found.update("".join(m.group().split()) for m in SPELLED.finditer(lower))
    return found


def windows(word: str) -> list[str]:
    """A word without marks around it, and its letters alone if there are marks within, in pieces of
    bounded length that together hold all of it."""
    bare = word.strip(EDGE)
    found = []
    for form in (bare,) if bare.isalpha() else (bare, "".join(filter(str.isalpha, bare))):
        if ORDER <= len(form) <= WINDOW:
            found.append(form)
        elif len(form) > WINDOW:
            found += [form[i : i + WINDOW] for i in range(0, len(form) - WINDOW // 2, WINDOW // 2)]
    return found


def _codes(words: list[str], width: int) -> np.ndarray:
    """Characters of words as numbers, 0 after the end."""
    return np.array(words, f"<U{width}").view(np.uint32).reshape(len(words), width).astype(np.int32)


def paired_kernel(left: np.ndarray, right: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Unnormalised kernel of each row of left with the same row of right (codes, 0 after the end).

    ends: length of the rows of left, in rising order.
    """
    n, m, b = left.shape[1], right.shape[1], len(left)
    left, right = np.ascontiguousarray(left.T), np.ascontiguousarray(np.where(right == 0, -1, right).T)
    square = np.float32(DECAY * DECAY)
    # prefix[i][t]: weight of common subsequences of i characters in left so far and right up to t
    prefix = [np.zeros((m + 1, b), np.float32) for _ in range(ORDER)]
    prefix[0] += 1
    total = np.zeros(b, np.float32)
    for s in range(n):
        k = int(np.searchsorted(ends, s, side="right"))  # rows before k have ended
        if k == b:
            break
        hit = (right[:, k:] == left[s, k:]) * square
        total[k:] += (hit * prefix[ORDER - 1][:m, k:]).sum(axis=0)
        for i in range(ORDER - 1, 0, -1):
            prefix[i][:, k:] *= DECAY
            new = hit * prefix[i - 1][:m, k:]
            ending = np.zeros(b - k, np.float32)
            for t in range(m):
                ending *= DECAY
                ending += new[t]
                prefix[i][t + 1, k:] += ending
    return total.astype(np.float64)


def pairs_kernel(words: list[str], others: list[str], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Kernel of words[i] with others[j], in batches of like length."""
    out = np.zeros(len(i))
    if not len(i):
        return out
    length = np.array([len(w) for w in words])
    left, right = _codes(words, int(length.max())), _codes(others, max(map(len, others)))
    order = np.argsort(length[i], kind="stable")
    for start in range(0, len(order), 8_192):
        part = order[start : start + 8_192]
        ends = length[i[part]]
        out[part] = paired_kernel(left[i[part]][:, : ends[-1]], right[j[part]], ends)
    return out


def own_kernel(words: list[str]) -> np.ndarray:
    """Kernel of each word with itself."""
    by_length = defaultdict(list)
    for k, w in enumerate(words):
        by_length[len(w)].append(k)
    out = np.zeros(len(words))
    for n, rows in by_length.items():
        code = _codes([words[k] for k in rows], n)
        for at in range(0, len(rows), 8_192):
            out[rows[at : at + 8_192]] = paired_kernel(code[at : at + 8_192], code[at : at + 8_192], np.full(min(8_192, len(rows) - at), n))
    return out


def _letters(words: list[str]) -> np.ndarray:
    """A bit for each character, by its code; characters that share a bit only weaken the bound."""
    code = _codes(words, max(map(len, words)))
    return np.bitwise_or.reduce(np.where(code == 0, 0, np.int64(1) << (code % 63).astype(np.int64)), axis=1)


class Landmarks:
    """Strings to compare with, and for each set of its letters whether a word that has just those can get above the floor."""

    def __init__(self, strings: list[str]):
        self.strings = strings
        self.norms = np.sqrt(own_kernel(strings))
        self.bits = [sorted({ord(c) % 63 for c in s}) for s in strings]
        self.open = [self._open(s, b, n) for s, b, n in zip(strings, self.bits, self.norms)]

    @staticmethod
    def _open(string: str, bits: list[int], norm: float) -> np.ndarray:
        """With some of the letters in common, a normalised value is at most the norm of the subsequences over these."""
        forms = []
        for mask in range(1 << len(bits)):
            on = {b for k, b in enumerate(bits) if mask >> k & 1}
            forms.append("".join(c if ord(c) % 63 in on else "\1" for c in string))
        plain = _codes(forms, len(string))
        other = np.where(plain == 1, 2, plain)  # what is left out matches nothing
        held = np.sqrt(paired_kernel(plain, other, np.full(len(forms), len(string))))
        return held > FLOOR * norm * (1 - 1e-6)

    def near(self, words: list[str]) -> np.ndarray:
        """Of every word and landmark, whether their value can be above the floor."""
        have = _letters(words)
        out = np.empty((len(words), len(self.strings)), bool)
        for j, (bits, opened) in enumerate(zip(self.bits, self.open)):
            mask = np.zeros(len(words), np.int64)
            for k, b in enumerate(bits):
                mask |= ((have >> b) & 1) << k
            out[:, j] = opened[mask]
        return out

    def features(self, words: list[str]) -> np.ndarray:
        """Normalised kernel values above the floor, of every word with every landmark."""
        out = np.zeros((len(words), len(self.strings)), np.float32)
        if not words or not self.strings:
            return out
        i, j = np.nonzero(self.near(words))
        used, i = np.unique(i, return_inverse=True)
        value = pairs_kernel([words[k] for k in used], self.strings, i, j) / self.norms[j]
        i = used[i]
        # a word's own kernel is at least that of its plain runs, each alone
        least = np.sqrt(np.maximum(1, np.array([len(w) for w in words]) - ORDER + 1) * DECAY ** (2 * ORDER))
        high = value > FLOOR * least[i] * (1 - 1e-5)
        i, j, value = i[high], j[high], value[high]
        used, at = np.unique(i, return_inverse=True)
        if len(used):
            own = np.sqrt(own_kernel([words[k] for k in used]))
            out[i, j] = np.maximum(0.0, (value / own[at] - FLOOR) / (1 - FLOOR))
        return out


class Model:
    """Landmarks with their weights; a text's value goes through a logistic curve."""

    def __init__(self, landmarks: list[str], weights: np.ndarray, bias: float, slope: float = 1.0, shift: float = 0.0):
        self.landmarks, self.weights, self.bias, self.slope, self.shift = Landmarks(landmarks), weights, bias, slope, shift

    def values(self, words: list[str]) -> np.ndarray:
        """Value of each word, the largest of its windows; the bias alone for one without any."""
        parts = [(k, w) for k, word in enumerate(words) for w in windows(word)]
        out = np.full(len(words), self.bias)
        if parts and len(self.weights):
            best = np.full(len(words), -np.inf)
            for at in range(0, len(parts), 20_000):
                some = parts[at : at + 20_000]
                found = self.landmarks.features([w for _, w in some]) @ self.weights + self.bias
                np.maximum.at(best, [k for k, _ in some], found)
            out = np.where(np.isfinite(best), best, out)
        return out

    def score(self, value: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * value + self.shift, -30, 30)))


def runs(word: str) -> set[str]:
    """Character runs of the windows of a word."""
    low, high = RUNS
    return {w[i : i + n] for w in windows(word) for n in range(low, high + 1) for i in range(len(w) - n + 1)}


class Runs:
    """Character runs of the distinct words of some texts, each by a number; a text's runs are looked up, never kept."""

    def __init__(self, texts: Iterable[Iterable[str]]):
        self.place: dict[str, int] = {}
        sizes, parts = array("q", [0]), array("q")
        for t in texts:
            for w in t:
                if w not in self.place:
                    self.place[w] = len(self.place)
                    before = len(parts)
                    parts.extend(map(hash, runs(w)))
                    sizes.append(len(parts) - before)
        self.starts = np.cumsum(np.frombuffer(sizes, np.int64))
        #: The numbers of the words' runs, word after word, and the hash of each number. They are dealt out by a few bits of the
        #: hash at a time, so that no sort holds all of them.
        hashes = np.frombuffer(parts, np.int64)
        deal = (hashes % 16).astype(np.uint8)
        self.numbers, found = np.empty(len(hashes), np.int32), [hashes[:0]]
        total = 0
        for k in range(16):
            at = np.flatnonzero(deal == k)
            some, number = np.unique(hashes[at], return_inverse=True)
            self.numbers[at] = number + total
            found.append(some)
            total += len(some)
        self.hashes = np.concatenate(found)

    def of(self, text: Iterable[str]) -> np.ndarray:
        """Numbers of the runs of a text, each once."""
        at = [self.place[w] for w in text]
        return np.unique(np.concatenate([self.numbers[:0], *(self.numbers[self.starts[k] : self.starts[k + 1]] for k in at)]))

    def count(self, texts: Iterable[Iterable[str]]) -> np.ndarray:
        """In how many of the texts each run is."""
        out = np.zeros(len(self.hashes), np.int64)
        for t in texts:
            out[self.of(t)] += 1
        return out


def _supports(inside: np.ndarray, n_inside: int, elsewhere: np.ndarray, n_elsewhere: int) -> np.ndarray:
    """Numbers of the runs that are in two or more texts and hardly in others, by how many of each they are in."""
    return np.flatnonzero((inside >= 2) & (elsewhere * n_inside <= 0.005 * inside * n_elsewhere))


def toxic_runs(toxic: list[list[str]], clean: list[list[str]]) -> tuple[dict[str, list[int]], int]:
    """Runs that toxic texts share and clean ones hardly have, with the numbers of their texts; and the support that isn't chance.

    Two texts are enough for that, unless clean texts share runs of their own: then it is the least support at which
    a part of the clean texts, against the rest of them, shows at most ``CHANCE`` of the runs that the toxic ones show.
    """
    known = Runs(chain(toxic, clean))
    step = max(2, -(-len(clean) // max(1, len(toxic))))
    part, rest = clean[::step], [t for k, t in enumerate(clean) if k % step]
    own, in_part, in_rest = (known.count(x) for x in (toxic, part, rest))
    by_chance = in_part[_supports(in_part, len(part), in_rest, len(rest))]
    shown = own[_supports(own, len(toxic), in_rest, len(rest))]
    least = 2
    top = int(max(shown, default=2))
    while least < top and (by_chance >= least).sum() > CHANCE * (shown >= least).sum():
        least += 1
    of = _supports(own, len(toxic), in_part + in_rest, len(clean))
    picked = of[own[of] >= min(least, max(2, len(toxic) // 100))]
    wanted = set(known.hashes[picked].tolist())
    numbers = np.zeros(len(known.hashes), bool)
    numbers[picked] = True
    having = {w for w, k in known.place.items() if numbers[known.numbers[known.starts[k] : known.starts[k + 1]]].any()}
    found: dict[str, list[int]] = defaultdict(list)
    for k, t in enumerate(toxic):
        for r in {r for w in t if w in having for r in runs(w) if hash(r) in wanted}:
            found[r].append(k)
    return found, least


def pick_landmarks(shared: dict[str, list[int]], n_toxic: int, least: int) -> list[str]:
    """Runs of the most toxic texts, none holding another: ``TOXIC_LANDMARKS`` that a hundredth of the texts have, and then
    those of ``least`` texts or more that any text without one has."""
    ranked = sorted(shared, key=lambda r: (-len(shared[r]), -len(r), r))
    picked: list[str] = []
    covered: set[int] = set()
    for run in ranked:
        n = len(shared[run])
        common = n >= max(2, n_toxic // 100) and len(picked) < TOXIC_LANDMARKS
        alone = n >= least and not covered.issuperset(shared[run])
        if (common or alone) and not any(run in p or p in run for p in picked):
            picked.append(run)
            covered.update(shared[run])
    return picked


def _root(landmarks: Landmarks) -> np.ndarray:
    """Inverse root of the landmarks' own normalised kernel matrix."""
    s = landmarks.strings
    i, j = (x.ravel() for x in np.meshgrid(np.arange(len(s)), np.arange(len(s)), indexing="ij"))
    k = pairs_kernel(s, s, i, j).reshape(len(s), len(s)) / np.outer(landmarks.norms, landmarks.norms)
    values, vectors = np.linalg.eigh((k + k.T) / 2)
    keep = values > 1e-4 * values.max()
    return vectors[:, keep] / np.sqrt(values[keep])


def _svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-4, steps: int = 80) -> np.ndarray:
    """Squared hinge loss with a ridge, by Newton steps; the last column of x is the bias."""
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        slack = 1 - y * (x @ w)
        on = slack > 0
        grad = ridge * w - (x[on].T @ (weight[on] * y[on] * slack[on]))
        hess = ridge * np.eye(len(w)) + (x[on].T * weight[on]) @ x[on]
        step = np.linalg.solve(hess, grad)
        w = w - step
        if np.abs(step).max() < 1e-7:
            break
    return w


def gapped(word: str, rng: np.random.Generator) -> list[str]:
    """The word with a character inserted, once near its start and once near its end."""
    if not 4 <= len(word) < WINDOW:
        return []
    at = (int(rng.integers(1, len(word) // 2 + 1)), int(rng.integers(len(word) // 2, len(word))))
    return ["".join((word[:k], "xqzj.-"[int(rng.integers(6))], word[k:])) for k in at]


def _rows(landmarks: Landmarks, words: list[str]) -> dict[str, np.ndarray]:
    """Features of the words that resemble a landmark; most don't."""
    found = {}
    for at in range(0, len(words), 20_000):
        some = words[at : at + 20_000]
        x = landmarks.features(some)
        found.update((some[k], x[k].copy()) for k in np.flatnonzero(x.any(axis=1)))
    return found


def fit(toxic: Iterable[Iterable[str]], clean: Iterable[Iterable[str]]) -> Model:
    """A model from the distinct words of toxic and of clean texts; the same for every order of the texts."""
    toxic, clean = sorted(map(sorted, toxic)), sorted(map(sorted, clean))
    shared, least = toxic_runs(toxic, clean)
    picked = pick_landmarks(shared, len(toxic), least)
    if not picked or not clean:
        return Model([], np.empty(0), 0.0, 0.0, 4.0 if toxic and not clean else -4.0)
    rng = np.random.default_rng(11)
    of = [[intern(w) for x in t for w in windows(x)] for t in toxic]
    away_in = Counter(w for t in clean for w in {w for x in t for w in windows(x)})
    near, away = sorted({w for t in of for w in t}), sorted(away_in)
    close: list[str] = []
    for _ in range(2):
        landmarks = Landmarks(picked + close)
        plus, minus = _rows(landmarks, near), _rows(landmarks, away)
        model = _machine(landmarks, len(picked), of, plus, minus, away_in, len(clean), rng)
        if not len(model.weights):
            return model
        if not close:  # the clean words that come nearest to the landmarks become landmarks themselves
            value = {w: float(x @ model.weights) for w, x in minus.items()}
            close = [w for w in sorted(value, key=lambda w: (-value[w], w))[: max(CLEAN_LANDMARKS, len(picked) // 4)] if w not in picked]
    value = {w: float(x @ model.weights) + model.bias for x_of in (plus, minus) for w, x in x_of.items()}
    high = np.array([max((value.get(w, model.bias) for w in t), default=model.bias) for t in of])
    low = np.array([max((value.get(w, model.bias) for x in t for w in windows(x)), default=model.bias) for t in clean])
    model.slope, model.shift = _curve(high, low)
    return model


def _machine(
    landmarks: Landmarks, n_toxic: int, of: list[list[str]], plus: dict[str, np.ndarray], minus: dict[str, np.ndarray], away_in: Counter, n_clean: int, rng: np.random.Generator
) -> Model:
    """Weights of landmarks (the first n_toxic of them toxic) from the worst words of toxic texts (of) against all
    words of clean ones (away_in: in how many each is). plus, minus: features of the words that resemble any."""
    model = Model([], np.zeros(len(landmarks.strings)), 0.0)
    model.landmarks = landmarks
    root = _root(landmarks)
    some = sorted(minus)
    clean = np.vstack([*(minus[w] for w in some), np.zeros(len(landmarks.strings), np.float32)])  # the last row: all other words
    often = np.array([*(away_in[w] for w in some), n_clean]) / n_clean
    # the words of toxic texts that no clean text has and that come close to a toxic landmark; then the worst word of each text
    found = Counter(w for t in of for w in set(t) if w in plus and w not in away_in and plus[w][:n_toxic].max() >= 0.6)
    for _ in range(2):
        plain = sorted(found)
        if not plain:
            return Model([], np.empty(0), 0.0, 0.0, -4.0)
        more = [(g, w) for w in plain for g in gapped(w, rng)]
        rows = np.vstack([[plus[w] for w in plain], landmarks.features([g for g, _ in more]), clean])
        y = np.concatenate([np.ones(len(plain) + len(more)), -np.ones(len(clean))])
        count = np.concatenate([[found[w] / len(of) for w in plain], [0.5 * found[w] / len(of) for _, w in more], CLEAN_WEIGHT * often])
        w = _svm(np.hstack([rows @ root, np.ones((len(rows), 1))]), y, count)
        model.weights, model.bias = root @ w[:-1], float(w[-1])
        value = {w: float(x @ model.weights) for w, x in plus.items() if w not in away_in}
        for t in of:
            top = max((w for w in t if w in value), key=lambda w: (value[w], w), default=None)
            if top is not None:
                found[top] += 1
    return model


def _curve(high: np.ndarray, low: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve that is one half where the balanced error is least."""
    cuts = np.unique(np.concatenate([high, low]))
    h, lo = np.sort(high), np.sort(low)
    errors = np.searchsorted(h, cuts, side="left") / len(h) + FALSE_ALARM * (1 - np.searchsorted(lo, cuts, side="left") / len(lo))
    best = np.flatnonzero(errors == errors.min())
    at = cuts[best[0]]
    below = lo[lo < at]
    edge = below[-1] + (at - below[-1]) / 4 if len(below) else at - 0.5  # nearer to the clean side, for gaps
    slope = 6.0
    return slope, -slope * float(edge)


def learn(docs: DataFrame, labels: DataFrame, text: str = "text", label: str = "toxic", doc_id: str = "doc_id") -> Model:
    """A model from the rows of ``docs`` that have a label of 0 or 1 in ``labels``.

    About ``TOXIC_TEXTS`` and ``CLEAN_TEXTS`` of them, drawn by a hash of the id, reach the driver, as words.
    """
    marks = labels.where(F.col(label).isin(0, 1)).groupBy(F.col(doc_id).alias("id")).agg(F.max(label).cast("int").alias("mark"))
    n = {r.mark: r["count"] for r in marks.groupBy("mark").count().collect()}
    share = F.when(F.col("mark") == 1, min(1.0, TOXIC_TEXTS / max(1, n.get(1, 0)))).otherwise(min(1.0, CLEAN_TEXTS / max(1, n.get(0, 0))))
    drawn = marks.where(F.pmod(F.xxhash64("id", F.lit(9)), F.lit(1 << 32)) < share * float(1 << 32))
    # the draw bounds the ids, whatever the labels; so no text is shuffled to meet its label
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).join(F.broadcast(drawn), "id").select("mark", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in chunks(batches):
            words = [" ".join(sorted(units(t))) for t in strings(piece.column(1))]
            yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(words, pa.string())], ["mark", "words"])

    got = rows.mapInArrow(run, "mark int, words string").toArrow()
    # the words of a text are distinct already; a list of them takes a fraction of a set
    return fit(*([list(map(intern, w.as_py().split())) for m, w in zip(*got.columns) if m.as_py() == k] for k in (1, 0)))


class Scorer:
    """Scores texts, with a memory of words that is emptied by halves when it is full."""

    def __init__(self, model: Model):
        self.model, self.now, self.before = model, {}, {}

    def __call__(self, texts: Iterable[str]) -> np.ndarray:
        each = [units(t) for t in texts]
        new = set()
        for words in each:
            for w in words:
                if w not in self.now:
                    if w in self.before:
                        self.now[w] = self.before[w]
                    else:
                        new.add(w)
        new = sorted(new)
        self.now.update(zip(new, self.model.values(new).tolist()))
        known, least = self.now, self.model.bias
        value = np.array([max((known[w] for w in words), default=least) for words in each])
        for w in new:
            if len(w) > REMEMBERED_LENGTH:
                del known[w]
        if len(self.now) > REMEMBERED:
            self.before, self.now = self.now, {}
        return self.model.score(value) if len(value) else value


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score) of every row; null and empty texts score as texts without words. Repeated rows are
    all returned."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    kind = dict(docs.select(doc_id).dtypes)[doc_id]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(held.value)
        for piece in chunks(batches):
            found = scorer(strings(piece.column(1)))
            yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(found, pa.float64())], ["doc_id", "score"])

    return docs.select(doc_id, text).mapInArrow(run, f"doc_id {kind}, score double")


def without_toxic(docs: DataFrame, model: Model, limit: float = 0.5, text: str = "text") -> DataFrame:
    """Rows of ``docs``, whole, that score below ``limit``."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(held.value)
        for piece in chunks(batches):
            found = scorer(strings(piece.column(piece.schema.get_field_index(text))))
            yield piece.filter(pa.array(found < limit, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
