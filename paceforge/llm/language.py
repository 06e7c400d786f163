"""Language of texts by compression: the language whose dictionary makes a text smallest.

A text is reduced to its distinct words in lower case, in the order of their first use, so that junk, digits
and repetition don't count. Its pieces are compressed with zstandard, once for each language, with
raw-content dictionaries made of training texts, and once without any; the sizes of all pieces are summed. A tie of sizes
is looked at again with more levels. The lead of the best language over the next and over no dictionary at all
must reach a margin for the text's length. Margins are fitted on training texts that are in no dictionary, once as they are
and once with their own language left out, so that texts of a language never learned, and junk, are rejected.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator, Sequence
from zlib import crc32

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paceforge.llm.common import chunks, fold, strings

#: Bytes of a dictionary, texts drawn for it, texts drawn for the margins, both for each language.
DICTIONARY, DRAWN, FITTED = 32_000, 400, 400
#: A language with fewer texts gives all of them to its dictionary, any other at most this part.
FEW, PART = 32, 0.75
#: Bytes compressed together, zstandard's level, and the levels that look at a tie.
PIECE, LEVEL, TIE_LEVELS = 2_000, 9, (6, 12, 19)
#: Least lead of the best language, in bytes for each byte of the reduced text, where no margin is fitted.
MARGIN = 0.001
#: Lengths of the spans that margins are fitted on beside whole texts; a class of lengths is a power of two up to the last.
SPANS, LAST_CLASS = (24, 48, 96, 192, 384), 10
#: Leads that fit the margin of a class at least; the share of own texts that it may reject, and of others that it may keep.
ENOUGH, OWN_LOST, OTHERS_KEPT = 100, 0.005, 0.02
UNKNOWN = "und"
WORDS = re.compile(r"[^\W\d_]+")


def reduced(text: str | None) -> bytes:
    """Distinct words of a text; empty if it has no letter."""
    words = dict.fromkeys(WORDS.findall((text or "").lower()))
    return " ".join(words).encode() if any(c.isalpha() for w in words for c in w) else b""


def span(content: bytes, size: int) -> bytes:
    """Words of a reduced text from a place that its hash names, over its end to its start, up to ``size`` bytes."""
    if len(content) <= size:
        return content
    at = content.find(b" ", crc32(content) % len(content)) + 1
    turned = content[at:] + b" " + content[:at]
    return turned[:size].rpartition(b" ")[0] or turned[:size]


class Compressors:
    """A compressor for each language at one level, and one without a dictionary."""

    def __init__(self, dictionaries: dict[str, bytes], level: int):
        self.by = {}
        self.plain = zstandard.ZstdCompressor(level=level, write_content_size=False, write_checksum=False)
        for lang, content in dictionaries.items():
            held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            held.precompute_compress(level=level)
            self.by[lang] = zstandard.ZstdCompressor(level=level, dict_data=held, write_content_size=False, write_checksum=False, write_dict_id=False)

    def sizes(self, content: bytes) -> dict[str, int]:
        pieces = [content[i : i + PIECE] for i in range(0, len(content), PIECE)]
        return {lang: sum(len(c.compress(p)) for p in pieces) for lang, c in self.by.items()}

    def plain_size(self, content: bytes) -> int:
        return sum(len(self.plain.compress(content[i : i + PIECE])) for i in range(0, len(content), PIECE))


def lead(sizes: dict[str, float], plain: float, length: int) -> float:
    """Bytes for each byte of a text that the smallest of some sizes is ahead of the next and of the plain one."""
    first, *rest = sorted(sizes.values())[:2]
    return (min([plain, *rest]) - first) / length


def length_class(length: int) -> int:
    return min(length.bit_length(), LAST_CLASS)


def judge(content: bytes, first: Compressors, others: Sequence[Compressors], margins: dict[int, float] | None = None) -> tuple[str, float, bool]:
    """(language, score, rejected) of a reduced text."""
    if not content or not first.by:
        return UNKNOWN, 0.0, True
    sizes = {k: float(v) for k, v in first.sizes(content).items()}
    order = sorted(sizes, key=lambda k: (sizes[k], k))
    if len(order) > 1 and sizes[order[1]] == sizes[order[0]]:
        for more in others:
            for k, v in more.sizes(content).items():
                sizes[k] += v
        sizes = {k: v / (1 + len(others)) for k, v in sizes.items()}
        order = sorted(sizes, key=lambda k: (sizes[k], k))
    best = sizes[order[0]]
    score = 1 / sum(2 ** min(0.0, (best - s) / 2) for s in sizes.values())
    margin = (margins or {}).get(length_class(len(content)), MARGIN)
    return order[0], score, lead(sizes, first.plain_size(content), len(content)) < margin


def _teaching(docs: DataFrame, text: str, lang: str) -> tuple[DataFrame, DataFrame]:
    """(lang, text, draw) of the rows that teach, and (lang, count) of their distinct texts. Equal texts have one ``draw``."""
    rows = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"), F.xxhash64(F.col(text), F.lit(7)).alias("draw"))
    counts = rows.groupBy("lang", "draw").agg(F.lit(1).alias("one")).groupBy("lang").count()
    part = F.least(F.lit(DRAWN) / F.col("count"), F.when(F.col("count") < FEW, 1.0).otherwise(PART))
    return rows, counts.select("lang", part.alias("part"), F.ceil(part * F.col("count")).alias("texts"), (F.lit(FITTED) / F.col("count")).alias("more"))


def learn(docs: DataFrame, text: str = "text", lang: str = "lang") -> dict[str, bytes]:
    """A dictionary for each language of ``docs`` (rows without text, letter or language teach nothing).

    Distinct texts are drawn by a hash, about ``DRAWN`` for a language. Each gives an equal share of ``DICTIONARY`` bytes, a run
    of its words from a hashed place, so that a common opening or a text with many copies counts once. Twice that many bytes
    a language are what reaches the driver.
    """
    rows, counts = _teaching(docs, text, lang)
    place = F.pmod("draw", F.lit(1 << 32)) / float(1 << 32)
    drawn = rows.join(F.broadcast(counts), "lang").where(place < F.col("part")).select("lang", "draw", "texts", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in chunks(batches):
            sizes = [2 * DICTIONARY // max(1, n) for n in piece.column(2).to_pylist()]
            shares = [span(reduced(t), max(16, n)) for t, n in zip(strings(piece.column(3)), sizes)]
            yield pa.RecordBatch.from_arrays([piece.column(0), piece.column(1), pa.array(shares, pa.binary())], ["lang", "draw", "share"])

    got = drawn.mapInArrow(run, "lang string, draw long, share binary").where("length(share) > 0").groupBy("lang", "draw").agg(F.min("share").alias("share")).collect()
    parts = defaultdict(list)
    for r in got:
        parts[r.lang].append((r.draw, bytes(r.share)))
    return {k: b" ".join(span(s, max(16, DICTIONARY // len(v))) for _, s in sorted(v)).ljust(16) for k, v in sorted(parts.items())}


def fit_margins(docs: DataFrame, dictionaries: dict[str, bytes], text: str = "text", lang: str = "lang") -> dict[int, float]:
    """Margin of each class of lengths, from about ``FITTED`` texts a language that are in no dictionary.

    Texts and spans of them give the lead of their own language, and the lead that another one has when their own is
    left out. The margin lies a quarter of the way from what ``OTHERS_KEPT`` of the others exceed up to what ``OWN_LOST``
    of the own fall short of, and never above the latter. Classes with too few leads have none.
    """
    rows, counts = _teaching(docs, text, lang)
    place = F.pmod("draw", F.lit(1 << 32)) / float(1 << 32)
    drawn = rows.join(F.broadcast(counts), "lang").where((place >= F.col("part")) & (place < F.col("part") + F.col("more"))).select("lang", "draw", "text")
    held = docs.sparkSession.sparkContext.broadcast(dictionaries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = Compressors(held.value, LEVEL)
        for piece in chunks(batches):
            out: list[tuple] = []
            for own, draw, t in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist(), strings(piece.column(2))):
                whole = reduced(t)
                for content in {whole, *(span(whole, n) for n in SPANS)} - {b""}:
                    sizes, plain = by.sizes(content), by.plain_size(content)
                    others = {k: v for k, v in sizes.items() if k != own}
                    right = min(sizes, key=lambda k: (sizes[k], k)) == own
                    out.append((draw, length_class(len(content)), lead(sizes, plain, len(content)) if right else None, lead(others, plain, len(content)) if others else None))
            columns = [pa.array(c, t) for c, t in zip(zip(*out) if out else ((),) * 4, (pa.int64(), pa.int32(), pa.float64(), pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, ["draw", "class", "own", "others"])

    if not dictionaries:
        return {}
    leads = drawn.mapInArrow(run, "draw long, class int, own double, others double").distinct().toArrow().to_pydict()
    classes, own, others = (np.array(leads[k], float) for k in ("class", "own", "others"))
    margins = {}
    for k in np.unique(classes).astype(int).tolist():
        right, wrong = (x[(classes == k) & ~np.isnan(x)] for x in (own, others))
        if len(right) >= ENOUGH:
            high = float(np.quantile(right, OWN_LOST))
            low = max(0.0, float(np.quantile(wrong, 1 - OTHERS_KEPT))) if len(wrong) else 0.0
            margins[k] = max(MARGIN, min(high, low + (high - low) / 4))
    return margins


def _judged(dictionaries: dict[str, bytes], margins: dict[int, float] | None):
    """A function that judges the texts of a list."""
    first, others = Compressors(dictionaries, LEVEL), [Compressors(dictionaries, x) for x in TIE_LEVELS]
    return lambda texts: [judge(reduced(t), first, others, margins) for t in texts]


def identify(docs: DataFrame, dictionaries: dict[str, bytes], doc_id: str = "doc_id", text: str = "text", margins: dict[int, float] | None = None) -> DataFrame:
    """(doc_id, lang_pred, score, rejected) of every row; ``und``, 0 and rejected for a text that is null,
    has no letter, or where nothing was learned. A text whose lead is below the margin of its length is rejected, with the best
    language still named. Repeated rows are all returned."""
    held = docs.sparkSession.sparkContext.broadcast(dictionaries)
    kind = dict(docs.select(doc_id).dtypes)[doc_id]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judged = _judged(held.value, margins)
        for piece in chunks(batches):
            found = judged(piece.column(1).to_pylist())
            columns = [pa.array(c, t) for c, t in zip(zip(*found) if found else ((), (), ()), (pa.string(), pa.float64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([piece.column(0), *columns], ["doc_id", "lang_pred", "score", "rejected"])

    return docs.select(doc_id, text).mapInArrow(run, f"doc_id {kind}, lang_pred string, score double, rejected boolean")


def of_known_language(docs: DataFrame, dictionaries: dict[str, bytes], text: str = "text", margins: dict[int, float] | None = None) -> DataFrame:
    """Rows of ``docs``, whole, whose language isn't rejected."""
    held = docs.sparkSession.sparkContext.broadcast(dictionaries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judged = _judged(held.value, margins)
        for piece in chunks(batches):
            rejected = [r for _, _, r in judged(piece.column(piece.schema.get_field_index(text)).to_pylist())]
            yield piece.filter(pa.array([not r for r in rejected], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def learned_part(docs: DataFrame, parts: int = 5) -> DataFrame:
    """The rows that may teach: all but the held-out fold."""
    return docs.where(fold("doc_id", parts) != 0)
