"""Groups of spelling variants by asymmetric q-chunks.

Words are counted per task before the shuffle. Of two words that one edit (an inserted, deleted or replaced code point) tells apart, the
shorter one, x, gives two disjoint chunks, its halves, and the other one, y, its grams of those sizes. The edit lies in one half at most, so the
other half is a gram of y: at the same place if it is the first half, and if it is the second, shifted by the difference of the
lengths, which is one at most. Grams further off can't be met and are not made. A half alone is shared by many words, so the method is
applied again to what is left of both words: of its two halves one is preserved as well, and joins the key. Keys are joined by hash,
and the join itself verifies each pair by its edit distance, so only near words come out of it.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paceforge.llm.common import chunks, stored, strings

#: Code points and occurrences that a word has at least; how many times as frequent a form is as its variant.
LETTERS, OCCURRENCES, TIMES = 6, 5, 5
#: One of so many runs of letters has a code point taken out.
SLIPS = 199
#: Words, and bytes of texts, that a task counts before it sends them on.
HELD_WORDS, HELD_BYTES = 200_000, 32_000_000
#: Steps along forms that counts of 64 bits allow: each form is ``TIMES`` as frequent as the one before. Every round doubles the steps.
ROUNDS = 6


def slipped(run: str, number: int) -> str:
    """``run`` without one code point, where ``SLIPS`` divides its number."""
    if number % SLIPS:
        return run
    at = number % len(run)
    return run[:at] + run[at + 1 :]


def word_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", letters: int = LETTERS) -> DataFrame:
    """(word, n): how often each word of at least ``letters`` code points occurs in all texts.

    Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF with A-Z in lower case, after ``slipped`` by the CRC-32 of
    ``<doc_id>:<run>``. Null and empty texts have none, a missing id counts as '', and repeated rows count each.
    """
    # a run that is too short stays so with a code point less
    runs = re.compile(f"[a-zÀ-ÿ]{{{letters},}}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[str] = Counter()
        size = 0

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], ["word", "n"])
            found.clear()
            return out

        for piece in chunks(batches):
            for name, t in zip(strings(piece.column(0)), strings(piece.column(1))):
                start = crc32(f"{name}:".encode())
                own = Counter(runs.findall(t.encode().lower().decode()))
                for word, n in own.items():
                    number = crc32(word.encode(), start)
                    if not number % SLIPS:
                        word = slipped(word, number)
                        if len(word) < letters:
                            continue
                    found[word] += n
                size += len(t)
                if len(found) > HELD_WORDS or size > HELD_BYTES:
                    yield flush()
                    size = 0
        yield flush()

    own = docs.select(F.col(doc_id).cast("string").alias("doc_id"), F.col(text).alias("text"))
    return own.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _parts(word: Column, start: Column, size: Column) -> Column:
    return F.substr(word, start + 1, size)


def _keys(of: Column, word: Column, longer: Column) -> Column:
    """The keys of a word as one of length ``of``; ``longer`` is by how much it is longer itself (0 or 1).

    Half, and quarter of the rest: (first, first of the rest), (first, last), (last, first of the rest), (last, last of the rest).
    """
    half = F.floor(of / 2).cast("int")
    rest = of - half
    first, last = _parts(word, F.lit(0), half), _parts(word, half + longer, rest)
    after, before = F.floor(rest / 2).cast("int"), F.floor(half / 2).cast("int")
    quarters = [
        (first, half, after),
        (first, half + after + longer, rest - after),
        (last, F.lit(0), before),
        (last, before + longer, half - before),
    ]
    return F.array(*[F.xxhash64(of, F.lit(k), chunk, _parts(word, start, size)) for k, (chunk, start, size) in enumerate(quarters)])


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, n, other, other_n): all pairs of distinct words that one edit tells apart, each once; ``words`` has a row for each (word, n).

    ``word`` is the shorter one, of two equally long ones the smaller.
    """
    size = F.length("word")
    zero, one = F.lit(0), F.lit(1)
    short = words.select(F.explode(_keys(size, F.col("word"), zero)).alias("key"), "word", "n", size.alias("size"))
    grams = F.concat(_keys(size, F.col("word"), zero), _keys(size - 1, F.col("word"), one))
    long = words.select(F.explode(grams).alias("key"), F.col("word").alias("other"), F.col("n").alias("other_n"), size.alias("other_size"))
    shift = F.col("other_size") - F.col("size")
    ordered = (shift == 1) | ((shift == 0) & (F.col("word") < F.col("other")))
    near = ordered & (F.levenshtein("word", "other", 1) == 1)
    return short.join(long, (short.key == long.key) & near).select("word", "n", "other", "other_n").distinct()


def _roots(links: DataFrame) -> DataFrame:
    """(word, root): where following the forms of ``links`` (word, root) ends, by steps that double."""
    found = links
    for _ in range(ROUNDS):
        ahead = found.select(F.col("word").alias("root"), F.col("root").alias("next"))
        found = stored(found.select("word", "root").join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        if not found.where("moved").head(1):
            break
    return found.select("word", "root")


def variants(counts: DataFrame, letters: int = LETTERS, occurrences: int = OCCURRENCES, times: int = TIMES) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of ``counts`` (word, n) that is long and frequent enough.

    form: the near word that is most frequent (ties: the smallest), if that is ``times`` as often as the word at least; root: the last of the
    forms that follow, the word itself without one. An empty table gives none.
    """
    words = stored(counts.where((F.length("word") >= letters) & (F.col("n") >= occurrences)).select("word", "n"))
    pairs = near_pairs(words)
    sides = pairs.unionAll(pairs.select("other", "other_n", "word", "n"))
    alone = words.select("word", "n", F.lit(None).cast("string").alias("other"), F.lit(None).cast("long").alias("other_n"))
    # words without a near one take part as well, so no join is needed to keep them
    best = F.min_by(F.struct("other", "other_n"), F.when(F.col("other").isNotNull(), F.struct(-F.col("other_n"), F.col("other"))))
    found = sides.unionAll(alone).groupBy("word").agg(F.max("n").alias("n"), F.count("other").alias("n_near"), best.alias("best"))
    enough = F.col("best.other_n") >= times * F.col("n")
    found = stored(found.select("word", F.when(enough, F.col("best.other")).alias("form"), "n", "n_near", F.when(enough, F.col("best.other_n")).alias("form_n")))
    roots = _roots(found.where("form is not null").select("word", F.col("form").alias("root")))
    return found.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
