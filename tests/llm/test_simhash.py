import random

import numpy as np
import xxhash

from paceforge.llm import simhash

SCHEMA = "doc_id long, text string"


def plain_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    """{doc_id: component} by comparing all pairs."""
    ids = sorted({d for d, _ in prints if d is not None})
    of = {d: f for d, f in prints if d is not None}
    group = {d: d for d in ids}
    changed = True
    while changed:
        changed = False
        for a in ids:
            for b in ids:
                if (of[a] ^ of[b]).bit_count() <= 2 and group[b] > group[a]:
                    group[b], changed = group[a], True
    return group


def test_fingerprint():
    for text in ["", " \n", "One", "one TWO", "a b c", "Ä Ö ü a b c d", "the cat\tsat  on the mat " * 9, "x\x1cy z w"]:
        assert simhash.fingerprint(text) == plain_fingerprint(text)
    long = " ".join(random.Random(1).choices(["ab", "cd", "ef", "gh"], k=40_000))
    assert simhash.fingerprint(long) == plain_fingerprint(long)


def test_masks_meet_every_pair_within_the_radius():
    masks = [m % (1 << 64) for m in simhash.key_masks()]
    for i in range(64):
        for j in range(i, 64):
            bits = (1 << i) | (1 << j)
            assert any(not bits & m for m in masks)
    assert all(m.bit_count() >= 35 for m in masks)


def test_rows_and_edge_cases(spark):
    base = [f"w{i}" for i in range(400)]
    near = base[:]
    near[200] = "changed"
    rows = [(5, " ".join(base)), (9, " ".join(near)), (7, " ".join(base)), (7, " ".join(base)), (3, None), (4, ""), (6, "!"), (None, " ".join(base)), (8, "other text of its own here")]
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' as fp", "1 as component_id", "2 as node")
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    prints = [(d, plain_fingerprint(t)) for d, t in rows]
    group = plain_components(prints)
    want = sorted((str(d), f"{f:016x}", str(group.get(d))) for d, f in prints)
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got) == want
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(["None", *map(str, {group[d] for d in group})])


def test_empty(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert simhash.near_duplicates(docs).collect() == []
    assert simhash.one_of_each(docs).collect() == []


def test_links_of_dense_and_scattered_fingerprints(spark):
    """A crowd within a few bits, chains and strangers, with tiles small enough to be cut."""
    rng = np.random.default_rng(5)
    values = {int(x) for x in rng.integers(0, 2**63, 150)}
    centre = int(rng.integers(0, 2**63))
    for _ in range(150):
        x = centre
        for k in rng.integers(0, 64, 3):
            x ^= 1 << int(k)
        values.add(x)
    chain = int(rng.integers(0, 2**63))
    for k in range(0, 20, 2):
        chain ^= 3 << k
        values.add(chain)
    values = sorted(values)
    ids = rng.permutation(len(values)).tolist()
    want = plain_components(list(zip(ids, values)))
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    nodes = spark.createDataFrame(list(zip(ids, signed)), "node long, fp long")
    for tile in (16, 1024):
        found = {r.node: r.component for r in simhash.components(simhash.links(nodes, tile)).collect()}
        assert {d: found.get(d, d) for d in ids} == want
