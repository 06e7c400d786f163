"""Exact token counts of every prefix of a text, for byte-level merges with word ends.

Of a word, the last token of each prefix is the one that stays apart from the last token of what
precedes it; so counts for all prefixes come from one pass over the word. A prefix that is cut inside a
word ends a word there, which the second pass counts. The counts of whole words are remembered, and the counts
of a text are their running sum. That answers how many tokens a text has, how many any part of it from
the start has, and where to cut it for a budget, without encoding anything again.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from paceforge.llm.common import chunks, strings
from paceforge.llm.merges import NEVER, Merges

LIMIT = 2_048
END = "</w>"
#: In front of remembered words that are in byte marks already; no text holds it.
FAR = "\udcff"
#: Words whose counts a worker remembers.
REMEMBERED = 400_000
#: Texts of code points below this are split here, others by the library: it knows its Unicode version best.
PLAIN = 0x250
SPACES = "\t\n\x0b\x0c\r \x85\xa0"


def _byte_marks() -> list[str]:
    """The printable character that byte-level vocabularies write for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + rest.index(b)) for b in range(256)]


MARKS = _byte_marks()


class Counter:
    """Token counts by one vocabulary file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        steps = [s["type"] for s in (spec["pre_tokenizer"] or {}).get("pretokenizers", [])]
        if model["type"] != "BPE" or model.get("end_of_word_suffix") != END or steps != ["Split", "ByteLevel"]:
            raise ValueError(f"{path}: byte-level merges with word ends are needed")
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        ranks = {(a, b): k for k, (a, b) in enumerate(pairs)}

        def rank(a: str, b: str) -> int:
            return ranks.get((a, b), NEVER)

        def split(token: str) -> list[str]:
            if token.endswith(END) and len(token) > len(END):
                bare = token[: -len(END)]
                return [*bare[:-1], bare[-1] + END]
            return list(token)

        self.merges = Merges(model["vocab"], rank, split)
        self.open = {t: n for t, n in self.merges.number.items() if not t.endswith(END)}
        self.close = {t[: -len(END)]: n for t, n in self.merges.number.items() if t.endswith(END)}
        self.longest = max(map(len, self.open | self.close))
        specials = [t["content"] for t in spec["added_tokens"]]
        self.specials = re.compile("|".join(map(re.escape, sorted(specials, key=len, reverse=True)))) if specials else None
        letters, numbers = ("".join(re.escape(chr(c)) for c in range(PLAIN) if unicodedata.category(chr(c))[0] == k) for k in "LN")
        split_by = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.words = re.compile(split_by.replace(r"[\p{L}]+", f"[{letters}]+").replace(r"[\p{N}]", f"[{numbers}]").replace(r"[^\s\p{L}\p{N}]+", f"[^{re.escape(SPACES)}{letters}{numbers}]+"))
        self.far = re.compile(f"[^\\x00-{chr(PLAIN - 1)}]")
        self.spaces = re.compile(f"[{re.escape(SPACES)}]+")
        self.now: dict[str, int] = {}
        self.before: dict[str, int] = {}

    def prefixes(self, word: str) -> tuple[list[int], list[int]]:
        """Counts of every prefix of a word of byte marks: open, with the word going on, and closed there."""
        n, apart, longest = len(word), self.merges.apart, self.longest
        last, count, closed = [0] * (n + 1), [0] * (n + 1), [0] * (n + 1)
        for i in range(1, n + 1):
            for j in range(max(0, i - longest), i):
                t = self.open.get(word[j:i])
                if t is not None and (j == 0 or apart(last[j], t)):
                    last[i], count[i] = t, count[j] + 1
                    break
            closed[i] = self._closed(word, i, last, count)
        return count, closed

    def _closed(self, word: str, i: int, last: list[int], count: list[int]) -> int:
        for j in range(max(0, i - self.longest), i):
            t = self.close.get(word[j:i])
            if t is not None and (j == 0 or self.merges.apart(last[j], t)):
                return count[j] + 1
        raise ValueError("a byte has no token")

    def word_tokens(self, word: str) -> int:
        """Count of a whole word of byte marks: all its prefixes but the last only as they go on."""
        n, apart, longest, tokens = len(word), self.merges.apart, self.longest, self.open
        last, count = [0] * n, [0] * n
        for i in range(1, n):
            for j in range(i - longest if i > longest else 0, i):
                t = tokens.get(word[j:i])
                if t is not None and (j == 0 or apart(last[j], t)):
                    last[i], count[i] = t, count[j] + 1
                    break
        return self._closed(word, n, last, count)

    def parts(self, text: str) -> Iterator[str]:
        """A text between its special strings, and '' for each of those."""
        at = 0
        for m in self.specials.finditer(text) if self.specials else ():
            yield text[at : m.start()]
            yield ""
            at = m.end()
        yield text[at:]

    def pieces(self, part: str) -> list[str]:
        """Words of a part, as the library splits it: in lower case, or in byte marks for ``far`` text."""
        if self.far.search(part):
            normal = self.library.normalizer.normalize_str(part)
            return [w for w, _ in self.library.pre_tokenizer.pre_tokenize_str(normal)]
        return self.words.findall(self.spaces.sub(" ", part).lower())

    @staticmethod
    def marks(word: str) -> str:
        return "".join(MARKS[b] for b in word.encode())

    def _learn(self, words: set[str], marked: bool) -> dict[str, int]:
        """Counts of words, from memory where they are there."""
        now = self.now
        if len(now) > REMEMBERED:
            self.before, self.now = now, {}
            now = self.now
        for w in words:
            key = FAR + w if marked else w
            if key not in now:
                found = self.before.get(key)
                now[key] = found if found is not None else self.word_tokens(w if marked else w if w.isascii() and w.isalnum() else self.marks(w))
        return now

    def tokens(self, text: str) -> int:
        """Tokens of a whole text, none added."""
        total = 0
        for k, part in enumerate(self.parts(text) if self.specials and self.specials.search(text) else (text,)):
            if k % 2:
                total += 1
                continue
            words = self.pieces(part)
            marked = bool(self.far.search(part))
            known = self._learn(set(words), marked)
            total += sum(known[FAR + w] for w in words) if marked else sum(map(known.__getitem__, words))
        return total

    def word_ends(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """For each word of a text without special strings: where it ends in the normalised text, and the tokens up to there."""
        normal = self.library.normalizer.normalize_str(text)
        ends, counts = [], []
        for word, (_, stop) in self.library.pre_tokenizer.pre_tokenize_str(normal):
            ends.append(stop)
            counts.append(self.word_tokens(word))
        return np.array(ends, np.int64), np.cumsum(np.array(counts, np.int64))

    def cut(self, text: str, budget: int) -> int:
        """Code points of the longest start of the normalised text that has at most ``budget`` tokens."""
        normal = self.library.normalizer.normalize_str(text)
        total, at = 0, 0
        for word, (start, stop) in self.library.pre_tokenizer.pre_tokenize_str(normal):
            whole = self.word_tokens(word)
            if total + whole > budget:
                _, closed = self.prefixes(word)
                plain = normal[start:stop]
                fits = [k for k in range(1, len(plain)) if total + closed[len(plain[:k].encode())] <= budget]
                return start + fits[-1] if fits else start
            total, at = total + whole, stop
        return len(normal)


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    """The counter of a vocabulary file, one for each worker."""
    return Counter(path)


def count(docs: DataFrame, path: str, limit: int = LIMIT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row; a null text counts as empty. Repeated rows are
    all returned. path: the vocabulary file, on every machine."""
    kind = dict(docs.select(doc_id).dtypes)[doc_id]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = counter(path)
        for piece in chunks(batches):
            found = pa.array([held.tokens(t) for t in strings(piece.column(1))], pa.int64())
            size = pc.fill_null(pc.binary_length(piece.column(1)), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([piece.column(0), size, found, pc.greater(found, limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select(doc_id, text).mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")


def prefix_counts(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ends, tokens): of every text the ends of its words in the normalised text, and the tokens up to each."""
    kind = dict(docs.select(doc_id).dtypes)[doc_id]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = counter(path)
        for piece in chunks(batches):
            found = [held.word_ends(t) for t in strings(piece.column(1))]
            columns = [pa.array([f[k] for f in found], pa.list_(pa.int64())) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([piece.column(0), *columns], ["doc_id", "ends", "tokens"])

    return docs.select(doc_id, text).mapInArrow(run, f"doc_id {kind}, ends array<long>, tokens array<long>")


def cuts(docs: DataFrame, path: str, budget: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, kept): code points of the longest start of each normalised text within ``budget`` tokens."""
    kind = dict(docs.select(doc_id).dtypes)[doc_id]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = counter(path)
        for piece in chunks(batches):
            kept = pa.array([held.cut(t, budget) for t in strings(piece.column(1))], pa.int64())
            yield pa.RecordBatch.from_arrays([piece.column(0), kept], ["doc_id", "kept"])

    return docs.select(doc_id, text).mapInArrow(run, f"doc_id {kind}, kept long")
