"""SimHash near-duplicates: tiled exact comparison of fingerprints.

A fingerprint has a bit set where over half of a text's shingle hashes have it set. Texts whose
fingerprints differ in two bits or fewer are linked; groups are what links reach.

Equal fingerprints are one row from the start, so copies cost nothing. The others are compared tile
by tile with numpy's exclusive-or and bit count, in popcount order, and a pair of tiles is skipped
once the population counts differ by more than the radius. So that the tiles to compare stay few
at any size, they are cut by exact pigeonhole keys: of three blocks of bits, a pair within two
bits agrees on one, and on one third of what is left, so it meets under at least one of nine keys of
35 bits or more. A key with more than ``TILE`` fingerprints is cut into tiles by population count and
hash, and each pair of its tiles within the radius is a unit of work of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paceforge.llm.common import map_chunks, stored, strings
from paceforge.llm.components import components

RADIUS = 2
SHINGLE = 3
SEED = 42
#: Fingerprints that one unit of comparison holds of a side.
TILE = 1_024
#: Shingles hashed before their bits are counted.
BLOCK = 32_768


def fingerprint(text: str) -> int:
    """64 bits of a whole text; 0 without a word."""
    words = text.encode().lower().split()  # of bytes: A-Z only, and \x20 \x09-\x0D only
    if not words:
        return 0
    line = b" ".join(words)
    ends = list(accumulate(map(len, words), lambda at, n: at + n + 1))
    starts = [0, *(e + 1 for e in ends[: max(0, len(words) - SHINGLE)])]
    ends = ends[min(SHINGLE, len(words)) - 1 :]
    counts = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(starts), BLOCK):
        hashes = [digest(line[a:b], SEED) for a, b in zip(starts[at : at + BLOCK], ends[at : at + BLOCK])]
        octets = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(starts), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp long) of every row; a null text counts as empty."""

    def work(piece: pa.RecordBatch) -> pa.RecordBatch:
        found = np.array([fingerprint(t) for t in strings(piece.column(1))], np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays([piece.column(0), pa.array(found)], ["doc_id", "fp"])

    return map_chunks(docs.select(F.col(doc_id).cast("long").alias("doc_id"), text), work, "doc_id long, fp long")


def key_masks() -> list[int]:
    """Nine masks; two fingerprints within two bits are equal under one of them at least."""
    edges = [round(64 * i / 9) for i in range(10)]
    part = [((1 << (edges[i + 1] - edges[i])) - 1) << edges[i] for i in range(9)]
    masks = []
    for block in range(3):
        rest = [part[i] for i in range(9) if i // 3 != block]
        masks += [sum(part[3 * block : 3 * block + 3]) + rest[2 * j] + rest[2 * j + 1] for j in range(3)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _merge(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Labels after the linked places i, j got the smaller label of both, all the way down."""
    while len(i):
        low = np.minimum(label[i], label[j])
        np.minimum.at(label, label[i], low)
        np.minimum.at(label, label[j], low)
        while (label != (down := label[label])).any():
            label = down
        apart = label[i] != label[j]
        i, j = i[apart], j[apart]
    return label


def linked(fp: np.ndarray, node: np.ndarray, side: np.ndarray, tile: int = 512) -> tuple[np.ndarray, np.ndarray]:
    """Links (node, smallest node of its group here) of one unit. With two sides, only links between
    the sides are looked for."""
    order = np.argsort(np.bitwise_count(fp), kind="stable")
    fp, node, side = fp[order], node[order], side[order]
    ones = np.bitwise_count(fp).astype(np.int16)
    label = np.arange(len(fp))
    two = bool(side.any())
    left = np.flatnonzero(side == 0)
    right = np.flatnonzero(side == 1) if two else left
    for a in range(0, len(left), tile):
        rows = left[a : a + tile]
        for b in range(0 if two else a, len(right), tile):
            cols = right[b : b + tile]
            if ones[cols[0]] - ones[rows[-1]] > RADIUS or ones[rows[0]] - ones[cols[-1]] > RADIUS:
                continue
            near = np.bitwise_count(fp[rows][:, None] ^ fp[cols][None, :]) <= RADIUS
            i, j = np.nonzero(near)
            label = _merge(label, rows[i], cols[j])
    low = node.copy()
    np.minimum.at(low, label, node)
    low = low[label]
    away = low != node
    return node[away], low[away]


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of the units of one partition, which come in order of their unit."""
    rest = None
    for batch in batches:
        if not batch.num_rows:
            continue
        got = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        rest = got if rest is None else [np.concatenate(x) for x in zip(rest, got)]
        mask, key, unit = rest[:3]
        edge = np.flatnonzero((mask[1:] != mask[:-1]) | (key[1:] != key[:-1]) | (unit[1:] != unit[:-1])) + 1
        if len(edge):
            yield _links([x[: edge[-1]] for x in rest], edge[:-1])
            rest = [x[edge[-1] :] for x in rest]
    if rest is not None:
        yield _links(rest, np.empty(0, np.int64))


def _links(columns: list[np.ndarray], edge: np.ndarray) -> pa.RecordBatch:
    side, fp, node = columns[3], columns[4].view(np.uint64), columns[5]
    bounds = np.concatenate([[0], edge, [len(fp)]])
    more = np.flatnonzero(np.diff(bounds) > 1)
    found = [linked(fp[s], node[s], side[s]) for s in (slice(bounds[k], bounds[k + 1]) for k in more)]
    sides = [np.concatenate([f[k] for f in found]) if found else np.empty(0, np.int64) for k in (0, 1)]
    return pa.RecordBatch.from_arrays([pa.array(x) for x in sides], ["a", "b"])


def links(nodes: DataFrame, tile: int = TILE) -> DataFrame:
    """(a, b) links that join all nodes (columns node, fp; fp unique) within the radius."""
    pick = F.explode(F.array([F.struct(F.lit(k).alias("mask"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for k, m in enumerate(key_masks())]))
    keyed = nodes.select("node", "fp", pick.alias("at")).select("at.mask", "at.key", "fp", "node")
    by = ["mask", "key"]
    ones = F.bit_count("fp")
    large = stored(keyed.groupBy(by).count().where(F.col("count") > tile).select(by))
    small = keyed.join(large, by, "left_anti").select(*by, F.lit(0).cast("long").alias("unit"), F.lit(0).alias("side"), "fp", "node")

    # tiles of the large keys: one population count each, cut further by hash where that is large
    banded = keyed.join(large, by).withColumn("ones", ones)
    cuts = banded.groupBy(*by, "ones").count().select(*by, "ones", F.ceil(F.col("count") / tile).cast("int").alias("cuts"))
    tiles = stored(cuts.select(*by, "ones", "cuts", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)).alias("cut")))
    one = tiles.select(*by, F.col("ones").alias("ones_a"), F.col("cut").alias("cut_a"))
    two = tiles.select(*by, F.col("ones").alias("ones_b"), F.col("cut").alias("cut_b"))
    near = (F.col("ones_b") <= F.col("ones_a") + RADIUS) & (
        (F.col("ones_a") < F.col("ones_b")) | ((F.col("ones_a") == F.col("ones_b")) & (F.col("cut_a") <= F.col("cut_b")))
    )
    pairs = one.join(two, by).where(near)
    pairs = pairs.withColumn("unit", F.xxhash64("ones_a", "cut_a", "ones_b", "cut_b"))
    same = (F.col("ones_a") == F.col("ones_b")) & (F.col("cut_a") == F.col("cut_b"))
    sides = pairs.select(*by, "unit", F.explode(F.when(same, F.array(F.struct(F.col("ones_a").alias("ones"), F.col("cut_a").alias("cut"), F.lit(0).alias("side")))).otherwise(
        F.array(*(F.struct(F.col(f"ones_{x}").alias("ones"), F.col(f"cut_{x}").alias("cut"), F.lit(k).alias("side")) for k, x in enumerate("ab")))
    )).alias("of")).select(*by, "unit", "of.ones", "of.cut", "of.side")
    cut = F.pmod(F.xxhash64("fp"), F.col("cuts")).cast("int")
    dealt = banded.join(cuts, [*by, "ones"]).withColumn("cut", cut)
    split = dealt.join(sides, [*by, "ones", "cut"]).select(*by, "unit", "side", "fp", "node")

    units = small.unionByName(split).repartition(*by, "unit").sortWithinPartitions(*by, "unit")
    return units.mapInArrow(_compare, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row of ``docs``.

    component_id is the smallest doc_id that links reach, the row's own included. Null and empty texts
    have fingerprint 0 and are linked like any other. Repeated rows are all returned. A row without a
    doc_id cannot name or be named: it gets its fingerprint, no component, and links nothing.
    """
    found = stored(fingerprints(docs, doc_id, text))
    nodes = stored(found.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("node")))
    groups = components(links(nodes))
    named = nodes.join(groups, "node", "left").select(F.col("fp").alias("of"), F.coalesce("component", "node").alias("component_id"))
    joined = found.join(named, F.col("fp") == F.col("of"), "left")
    return joined.select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"),
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` with the document that names its group. Rows that repeat a doc_id are one document, of which
    the row with the smallest text stays. Rows without a doc_id belong to no group and stay."""
    kept = near_duplicates(docs).where("doc_id = component_id").select("doc_id").distinct()
    named = docs.where("doc_id is not null").join(kept, "doc_id", "left_semi")
    rest = [c for c in docs.columns if c != "text"]
    turn = F.row_number().over(Window.partitionBy("doc_id").orderBy("text", F.xxhash64(*rest)))
    first = named.select(turn.alias("\0turn"), *docs.columns).where(F.col("\0turn") == 1).select(*docs.columns)
    return first.unionByName(docs.where("doc_id is null"))
