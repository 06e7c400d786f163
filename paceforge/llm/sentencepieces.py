"""SentencePiece encoding and decoding: one Viterbi pass over a trie of marked words.

A normalised text falls into words that carry their space mark (U+2581), where no piece of the vocabulary reaches
from one into the next. The distinct words of a step are sorted, which is the depth-first order of their trie; the
forward scores of a prefix are kept on a stack and used again by every word that starts with it. A forward
state holds the best score of a prefix and the piece that ends it. In a unigram model any piece may follow any
other and the best sum of scores wins. In a merge model (BPE) a piece may only follow one that merging leaves apart
from it; one path of each prefix is left, and it is the library's.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from os.path import commonprefix

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from paceforge.llm.common import chunks, strings
from paceforge.llm.merges import NEVER, Merges

MARK = "▁"
UNIGRAM, BPE = 1, 2
#: Kinds of pieces in a model file.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
#: What the library takes off the lowest score for an unknown character.
UNKNOWN_COST = 10.0
#: Words whose pieces a worker remembers, and code points they have at most: a text without spaces is one word.
REMEMBERED, SHORT = 300_000, 64


class Pieces:
    """Encoder and decoder of one model file."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        self.library = SentencePieceProcessor(model_file=path)
        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        self.kind = model.trainer_spec.model_type
        if self.kind not in (UNIGRAM, BPE) or any(p.type == USER for p in model.pieces):
            raise ValueError(f"{path}: a unigram or merge model without own symbols is needed")
        rules = model.normalizer_spec
        self.plain = not rules.precompiled_charsmap and rules.add_dummy_prefix and not rules.remove_extra_whitespaces and rules.escape_whitespaces
        self.prefix = rules.add_dummy_prefix
        ids = {p.piece: k for k, p in enumerate(model.pieces) if p.type == NORMAL}
        if any(re.search(f"[^{MARK}]{MARK}", p) for p in ids):
            raise ValueError(f"{path}: a piece reaches over a space")
        self.scores = [p.score for p in model.pieces]
        self.unknown = next(k for k, p in enumerate(model.pieces) if p.type == UNKNOWN)
        self.unknown_score = min((p.score for p in model.pieces if p.type == NORMAL), default=0.0) - UNKNOWN_COST
        octets = {int(p.piece[3:5], 16): k for k, p in enumerate(model.pieces) if p.type == BYTE}
        self.octets = [octets[b] for b in range(256)] if len(octets) == 256 and model.trainer_spec.byte_fallback else None
        self.merges = Merges(ids, self._rank(ids), list) if self.kind == BPE else None
        self.ids = self.merges.number if self.merges else ids
        self.singles = {p for p in ids if len(p) == 1}
        self.tails = self._reversed_trie()
        # characters that stand in no longer piece are words of their own
        inside = {c for p in ids if len(p) > 1 for c in p}
        alone = "".join(re.escape(c) for c in "\n\r\t\0" if c not in inside)
        self.words = re.compile(f"[{alone}]|{MARK}*[^{MARK}{alone}]+|{MARK}+" if alone else f"{MARK}*[^{MARK}]+|{MARK}+")
        self.spelled = [self._spelling(p) for p in model.pieces]
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}

    def _reversed_trie(self) -> dict:
        """The vocabulary by last characters first: character -> (further characters, number of the piece that starts here or -1).

        A walk back from the end of a prefix meets all pieces that end there, and stops where no piece goes on.
        """
        found: dict = {}
        for piece, number in sorted(self.ids.items(), key=lambda p: len(p[0])):
            node = found
            for c in piece[:0:-1]:
                node = node.setdefault(c, ({}, -1))[0]
            held = node.get(piece[0])
            node[piece[0]] = (held[0] if held else {}, number)
        return found

    def _rank(self, ids: dict[str, int]):
        # scores as ranks: a higher score goes first, equal scores from the left
        order = {s: k for k, s in enumerate(sorted({self.scores[i] for i in ids.values()}, reverse=True))}
        ranks = {p: order[self.scores[i]] for p, i in ids.items()}
        return lambda a, b: ranks.get(a + b, NEVER)

    @staticmethod
    def _spelling(piece) -> bytes:
        if piece.type == BYTE:
            return bytes([int(piece.piece[3:5], 16)])
        return {UNKNOWN: " ⁇ ".encode(), CONTROL: b""}.get(piece.type, piece.piece.encode())

    def normalised(self, text: str) -> str:
        if not text:
            return ""
        return (MARK + text).replace(" ", MARK) if self.plain else self.library.normalize(text)

    def paths(self, words: Iterable[str]) -> Iterator[tuple[str, list[int]]]:
        """Pieces of each word of a sorted row of distinct words, each followed from where it leaves the word before."""
        forward = self._forward_merges if self.merges else self._forward_scores
        last, best, back, ends = "", [0.0], [0], [-1]  # by prefix: score, where its last piece starts, that piece
        for word in words:
            if self.merges and MARK * 2 in word:
                yield word, self._spaced(word)
                continue
            shared = len(commonprefix((last, word)))
            del best[shared + 1 :], back[shared + 1 :], ends[shared + 1 :]
            forward(word, best, back, ends)
            last = word
            yield word, self._path(word, back, ends)

    def _forward_merges(self, word: str, best: list, back: list, ends: list) -> None:
        tails, scores, merges, known = self.tails, self.scores, self.merges, self.merges.known
        for i in range(len(best), len(word) + 1):
            node, j, found = tails, i, -1
            while j:
                step = node.get(word[j - 1])
                if step is None:
                    break
                j -= 1
                node, t = step
                if t >= 0:
                    before = ends[j]
                    apart = True if before < 0 else known.get(before << 20 | t)
                    if merges.apart(before, t) if apart is None else apart:
                        found = t
                        break
            if found < 0:
                best.append(best[i - 1] + self.unknown_score)
                back.append(i - 1)
            else:
                best.append(best[j] + scores[found])
                back.append(j)
            ends.append(found)

    def _forward_scores(self, word: str, best: list, back: list, ends: list) -> None:
        tails, scores = self.tails, self.scores
        for i in range(len(best), len(word) + 1):
            top, start, piece = -np.inf, i - 1, -1
            node = tails
            for j in range(i - 1, -1, -1):
                step = node.get(word[j])
                if step is None:
                    break
                node, t = step
                # of equal sums the longer piece
                if t >= 0 and best[j] + scores[t] >= top:
                    top, start, piece = best[j] + scores[t], j, t
            if word[i - 1] not in self.singles and best[i - 1] + self.unknown_score > top:
                top, start, piece = best[i - 1] + self.unknown_score, i - 1, -1
            best.append(top)
            back.append(start)
            ends.append(piece)

    def _spaced(self, word: str) -> list[int]:
        """Merges one by one, for runs of spaces: their pieces share one score, and then the order of merges decides."""
        found: list[int] = []
        for piece in self.merges.run(list(word))[0]:
            found += self._unknown(piece, found) if piece not in self.ids else [self.ids[piece]]
        return found

    def _unknown(self, char: str, before: list[int]) -> list[int]:
        """Pieces of a character that has none; unknown characters in a row are one piece."""
        if self.octets:
            return [self.octets[b] for b in char.encode()]
        return [] if before and before[-1] == self.unknown else [self.unknown]

    def _path(self, word: str, back: list, ends: list) -> list[int]:
        found: list[int] = []
        at = len(word)
        while at:
            if ends[at] >= 0:
                found.append(ends[at])
            else:
                found += self._unknown(word[back[at] : at], found)[::-1]
            at = back[at]
        return found[::-1]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Piece numbers of whole texts."""
        each = [self.words.findall(self.normalised(t)) for t in texts]
        known = self.known
        if len(known) > REMEMBERED:
            self.before, self.known = known, {}
            known = self.known
        new = set()
        for words in each:
            for w in set(words):
                if w not in known:
                    if w in self.before:
                        known[w] = self.before[w]
                    else:
                        new.add(w)
        known.update((w, np.array(path, "<i4").tobytes()) for w, path in self.paths(sorted(new)))
        found = [np.frombuffer(b"".join(map(known.__getitem__, words)), "<i4") for words in each]
        for w in new:
            if len(w) > SHORT:
                del known[w]
        return found if self.octets else [self._joined(f) for f in found]

    def _joined(self, ids: np.ndarray) -> np.ndarray:
        """Unknown pieces in a row, from neighbouring words, as one."""
        again = (ids[1:] == self.unknown) & (ids[:-1] == self.unknown)
        return ids[np.concatenate([[True], ~again])] if len(ids) else ids

    def decode(self, ids: np.ndarray) -> str:
        """Text of piece numbers; the mark in front, which encoding put there, goes."""
        text = b"".join(map(self.spelled.__getitem__, ids.tolist())).decode("utf-8", "replace").replace(MARK, " ")
        return text[1:] if self.prefix and text.startswith(" ") else text


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    """The model of a file, one for each worker."""
    return Pieces(path)


def encode(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, token_ids, n_tokens, round_trip) of every row; a null text counts as empty.

    round_trip: whether decoding gives the text back (not where it holds the mark U+2581 itself). Repeated rows are all
    returned. path: the model file, on every machine.
    """
    kind = dict(docs.select(doc_id).dtypes)[doc_id]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path)
        for piece in chunks(batches):
            texts = strings(piece.column(1))
            ids = model.encode(texts)
            size = np.array([len(x) for x in ids], np.int64)
            ends = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
            flat = pa.array(np.concatenate([np.empty(0, "<i4"), *ids]), pa.int32())
            same = pa.array([model.decode(x) == t for x, t in zip(ids, texts)], pa.bool_())
            yield pa.RecordBatch.from_arrays([piece.column(0), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat), pa.array(size), same], ["doc_id", "token_ids", "n_tokens", "round_trip"])

    return docs.select(doc_id, text).mapInArrow(run, f"doc_id {kind}, token_ids array<int>, n_tokens long, round_trip boolean")


def decode(tokens: DataFrame, path: str, doc_id: str = "doc_id", token_ids: str = "token_ids") -> DataFrame:
    """(doc_id, text) of rows of piece numbers; null numbers give an empty text."""
    kind = dict(tokens.select(doc_id).dtypes)[doc_id]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path)
        for piece in chunks(batches):
            texts = [model.decode(np.array(x or [], np.int64)) for x in piece.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return tokens.select(doc_id, token_ids).mapInArrow(run, f"doc_id {kind}, text string")
