"""Token counts and sentence pieces against the libraries."""

import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2
from tokenizers import Tokenizer

from paceforge.llm import sentencepieces, token_counts
from paceforge.llm.merges import Merges

WORDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
SF = "/root/testdata/sf0.001"
ALPHABET = "abcdefghijklmnopqrstuvwxyzéß'’12²_-!<|>ΣİǺ     \t\n日本ªǅ\x00\x1c\x85▁"
ODD = ["", " ", "a<|startoftext|>b <|endoftext|>", "I'LL we've İx", "ΑΣ ΣΑΣ", "éte", "x" * 5_000, "日" * 300, "a" + " " * 70 + "b", " " * 300, "!" * 500 + "\n" * 50]


def made_up(n, seed=1):
    r = random.Random(seed)
    return ["".join(r.choices(ALPHABET, k=r.randint(0, 40))) for _ in range(n)] + ODD


@pytest.fixture(scope="module")
def texts(spark):
    return [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect() if r.text is not None] + made_up(3_000)


def test_long_rows_merge_as_short_ones():
    model = sentencepieces.pieces(PIECES).merges
    r = random.Random(4)
    for _ in range(50):
        row = r.choices("▁▁▁▁thenai", k=r.randint(2, 39))
        assert model.run(row) == model._run_long(row)


def test_last_tokens_by_merging_every_prefix():
    """The tokens of each prefix, from pairs that stay apart, against merging that prefix."""
    model = token_counts.counter(WORDS)
    for word in ("understanding", "ththebleering", "aaaaaaaaaaa", "xqzjkv"):
        marks = model.marks(word)
        _, closed = model.prefixes(marks)
        for k in range(1, len(marks) + 1):
            assert closed[k] == len(model.merges.run([*marks[: k - 1], marks[k - 1] + "</w>"])[0])


def test_counts_equal_the_library(texts):
    library, model = Tokenizer.from_file(WORDS), token_counts.counter(WORDS)
    want = [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [model.tokens(t) for t in texts] == want


def test_prefixes_and_cuts_equal_the_library(texts):
    library, model = Tokenizer.from_file(WORDS), token_counts.counter(WORDS)
    size = lambda t: len(library.encode(t, add_special_tokens=False).ids)
    for text in [t for t in texts[:60] if "<|" not in t] + ["understandingly ththebleering", "日本語 text"]:
        normal = library.normalizer.normalize_str(text)[:400]
        ends, counts = model.word_ends(normal)
        assert [size(normal[:e]) for e in ends[:40]] == counts[:40].tolist()
        for budget in (0, 1, 3, 7, 10_000):
            kept = model.cut(normal, budget)
            fits = [k for k in range(len(normal) + 1) if size(normal[:k]) <= budget] if budget < 10 else [len(normal)]
            assert size(normal[:kept]) <= budget
            words = [e for e in ends if e <= max(fits)]
            assert kept >= (words[-1] if words else 0)


def test_count_rows(spark):
    rows = [(1, None), (2, ""), (2, ""), (None, "a b"), (3, "the cat " * 1_500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as n_tokens", "'x' as n_bytes")
    got = sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.count(docs, WORDS).collect())
    assert got == [("1", 0, 0, False), ("2", 0, 0, False), ("2", 0, 0, False), ("3", 12_000, 3_000, True), ("None", 3, 2, False)]
    assert {str(r.doc_id): r.kept for r in token_counts.cuts(docs, WORDS, 2_000).collect()} == {"1": 0, "2": 0, "None": 3, "3": 8_000}
    assert {str(r.doc_id): (r.ends[:2], r.tokens[:2]) for r in token_counts.prefix_counts(docs, WORDS).collect()}["None"] == ([1, 3], [1, 2])
    for result in (token_counts.count(docs.limit(0), WORDS), token_counts.cuts(docs.limit(0), WORDS, 5), token_counts.prefix_counts(docs.limit(0), WORDS)):
        assert result.collect() == []


def test_pieces_equal_the_library(texts):
    library, model = sentencepiece.SentencePieceProcessor(model_file=PIECES), sentencepieces.pieces(PIECES)
    got = model.encode(texts)
    assert [x.tolist() for x in got] == library.encode(texts, num_threads=1)
    assert [model.decode(x) == t for x, t in zip(got, texts)] == ["▁" not in t for t in texts]
    plain = [x for x, t in zip(got, texts) if "\x00" not in t]
    assert [model.decode(x) for x in plain] == [library.decode(x.tolist()) for x in plain]


def small_model(path, fallback):
    """A unigram model written by hand: no training."""
    model = sentencepiece_model_pb2.ModelProto()
    kinds = [("<unk>", 0, 2), ("<s>", 0, 3), ("</s>", 0, 3)]
    if fallback:
        kinds += [(f"<0x{b:02X}>", 0, 6) for b in range(256)]
    own = {"▁": -3.1, "a": -2.2, "b": -2.9, "ab": -3.3, "▁a": -2.5, "▁ab": -4.6, "ba": -3.05, "abab": -6.3, "aa": -4.1, "bb": -7.7, "▁▁": -5.2}
    for piece, score, kind in kinds + [(p, s, 1) for p, s in own.items()]:
        model.pieces.add(piece=piece, score=score, type=kind)
    model.trainer_spec.model_type = 1
    model.trainer_spec.byte_fallback = fallback
    model.trainer_spec.vocab_size = len(model.pieces)
    model.normalizer_spec.name = "identity"
    model.normalizer_spec.add_dummy_prefix = True
    model.normalizer_spec.remove_extra_whitespaces = False
    model.normalizer_spec.escape_whitespaces = True
    path.write_bytes(model.SerializeToString())
    return str(path)


@pytest.mark.parametrize("fallback", [False, True])
def test_unigram_model_equals_the_library(tmp_path, fallback):
    path = small_model(tmp_path / "u.model", fallback)
    library, model = sentencepiece.SentencePieceProcessor(model_file=path), sentencepieces.Pieces(path)
    r = random.Random(2)
    texts = ["".join(r.choices("aaabbb xé\n", k=r.randint(0, 25))) for _ in range(2_000)]
    differ = 0
    for mine, want in zip(model.encode(texts), library.encode(texts, num_threads=1)):
        # paths of one score are told apart by rounding alone
        assert abs(sum(model.scores[i] for i in mine) - sum(model.scores[i] for i in want)) < 1e-4
        assert model.decode(mine) == model.decode(np.array(want, np.int64))
        differ += mine.tolist() != want
    assert differ < 0.02 * len(texts)


def test_forward_states_are_shared(monkeypatch):
    """Every prefix of a row of sorted words is looked at once."""
    model = sentencepieces.Pieces(PIECES)
    steps = []
    plain = model._forward_merges

    def counted(word, best, back, ends):
        steps.append(len(word) + 1 - len(best))
        plain(word, best, back, ends)

    monkeypatch.setattr(model, "_forward_merges", counted)
    words = sorted(["▁the", "▁then", "▁thereby", "▁there", "▁a"])
    assert len(dict(model.paths(words))) == 5
    assert sum(steps) == len({w[:k] for w in words for k in range(1, len(w) + 1)})


def test_encode_rows(spark):
    rows = [(1, None), (2, ""), (None, "a b"), (2, "x▁y"), (2, "x▁y"), (4, "hello  there\n" * 5_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as n_tokens", "'x' as token_ids")
    found = sentencepieces.encode(docs, PIECES)
    got = found.collect()
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    assert sorted((str(r.doc_id), r.token_ids, r.n_tokens, r.round_trip) for r in got) == sorted(
        (str(d), library.encode(t or ""), len(library.encode(t or "")), "▁" not in (t or "")) for d, t in rows
    )
    back = {str(r.doc_id): r.text for r in sentencepieces.decode(found, PIECES).collect()}
    assert back["4"] == rows[-1][1] and back["1"] == ""
    assert sentencepieces.encode(docs.limit(0), PIECES).collect() == []
    assert sentencepieces.decode(found.limit(0), PIECES).collect() == []
    assert np.concatenate([np.array(r.token_ids) for r in got if r.doc_id == 4]).dtype.kind == "i"


def test_ranks_tie_from_the_left():
    ranks = {"aa": 0, "aaa": 1, "aaaa": 1}
    model = Merges({"a": 0, "aa": 1, "aaa": 2, "aaaa": 3}, lambda a, b: ranks.get(a + b, 1 << 60), list)
    assert model.run(list("aaaaa"))[0] == ["aaaa", "a"]
