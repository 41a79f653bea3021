"""SimHash near duplicates, linked through a vantage-point tree.

Fingerprints are routed down a tree of (vantage point, radius) to shards. By the
triangle inequality two fingerprints within ``distance`` that fall on different
sides of a radius both lie within ``distance`` of it, so it is enough that the
inner ones of that boundary are copied to the outer side: every close pair then
meets in some shard. A shard orders its members by their distance to one of them
and compares only those whose distances differ by ``distance`` at most.

Shards are planned for a multiple of the square root of the number of fingerprints,
so copies and comparisons share the growth and every size goes through the same
tree. Where no split helps, a leaf is dealt into blocks and each pair of blocks is
a shard of its own, so no task meets an unbounded group.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from abx.llm.components import connected_components, merge_labels
from abx.llm.runtime import columns_of, small_batches, texts_of, written

SEED = 42
BLOCK = 1 << 16         # shingles counted at once
ROOTS = 8               # a shard is planned for so many times the root of the number of fingerprints
SAMPLE = 1 << 18        # fingerprints that the tree is planned on, at most
LEAST_SAMPLE = 1 << 12  # at least, where a tenth of all is less
ROUTED = 1 << 16        # fingerprints that go down the tree at once
ROWS, COLUMNS = 64, 4096


def fingerprint(text: bytes | None, shingle: int = 3) -> int:
    """64-bit SimHash of a whole text (UTF-8): bit by bit, whether over half of the
    shingles' hashes have it. No words: zero."""
    words = (text or b"").lower().split()       # bytes: A-Z only, ASCII white space only
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    ones = np.zeros(64, np.int64)
    for a in range(0, n, BLOCK):
        part = words[a:a + BLOCK + shingle - 1]
        grams = map(b" ".join, zip(*(part[k:] for k in range(shingle)))) if n > 1 or len(part) >= shingle else [b" ".join(part)]
        h = np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(SEED)), np.uint64)
        for b in range(0, len(h), 4096):
            ones += np.unpackbits(h[b:b + 4096].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
                axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprint_column(shingle: int = 3):
    """A column function: text -> fingerprint as a (signed) long."""
    @F.arrow_udf("long")
    def fingerprinted(texts: pa.Array) -> pa.Array:
        got = np.array([fingerprint(t, shingle) for t in texts_of(texts)], np.uint64)
        return pa.array(got.view(np.int64), pa.int64())

    return fingerprinted


def hex_of(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


@dataclass(frozen=True)
class Leaf:
    """One shard, or where ``blocks`` is two or more, a shard for each pair of blocks,
    numbered from ``first`` on."""

    first: int
    blocks: int = 1

    @property
    def shards(self) -> int:
        return max(1, self.blocks * (self.blocks - 1) // 2)


@dataclass(frozen=True)
class Node:
    vantage: int
    radius: int
    inner: "Node | Leaf"
    outer: "Node | Leaf"


def shard_size(total: int) -> int:
    """Members that a shard is planned for among ``total`` fingerprints."""
    return max(8, ROOTS * math.isqrt(total))


def plan_tree(sample: np.ndarray, total: int, distance: int, shard: int, seed: int = 7) -> Node | Leaf:
    """A tree whose shards hold about ``shard`` of ``total`` fingerprints, copies included,
    as far as the sample tells. Only balance depends on the sample, not the result."""
    rng = np.random.default_rng(seed)
    sample = np.unique(sample)
    each = max(1.0, total / max(1, len(sample)))    # fingerprints that one of the sample stands for
    used = 0

    def leaf(members: int) -> Leaf:
        nonlocal used
        over = members * each / shard
        got = Leaf(used, math.ceil(2 * over) if over > 2 else 1)
        used += got.shards
        return got

    def grow(own: np.ndarray) -> Node | Leaf:
        if len(own) * each <= shard or len(own) < 8:
            return leaf(len(own))
        best = None
        for v in rng.choice(own, min(4, len(own)), replace=False):
            at = np.bincount(np.bitwise_count(own ^ v), minlength=65)
            inner = np.cumsum(at)
            copies = inner - np.concatenate((np.zeros(min(65, distance), np.int64), inner[:-distance] if distance else inner))
            outer = len(own) - inner + copies
            r = int(np.argmin(np.maximum(inner, outer)))
            worst = max(inner[r], outer[r])
            if best is None or worst < best[0]:
                best = (worst, v, r)
        worst, v, r = best
        if worst > 0.9 * len(own):      # one ball: a split would copy nearly all of it
            return leaf(len(own))
        d = np.bitwise_count(own ^ v)
        return Node(int(v), r, grow(own[d <= r]), grow(own[d > r - distance]))

    return grow(sample)


def route(fps: np.ndarray, tree: Node | Leaf, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """(shard, fingerprint) for each shard that a fingerprint belongs to."""
    shards, members, todo = [], [], [(tree, fps)]
    while todo:
        node, own = todo.pop()
        if not len(own):
            continue
        if isinstance(node, Node):
            d = np.bitwise_count(own ^ np.uint64(node.vantage)).astype(np.int16)
            todo += [(node.inner, own[d <= node.radius]), (node.outer, own[d > node.radius - distance])]
            continue
        if node.blocks < 2:
            shards.append(np.full(len(own), node.first, np.int64))
            members.append(own)
            continue
        mixed = own * np.uint64(0x9E3779B97F4A7C15)
        block = ((mixed ^ (mixed >> np.uint64(32))) % np.uint64(node.blocks)).astype(np.int64)
        for other in range(node.blocks):
            at = block != other
            i, j = np.minimum(block[at], other), np.maximum(block[at], other)
            shards.append(node.first + j * (j - 1) // 2 + i)
            members.append(own[at])
    if not shards:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(shards), np.concatenate(members)


def forest(fps: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges (member, its group's first) over the distinct ``fps`` of one shard, for all
    pairs within ``distance``: as many as members at most, however dense the groups."""
    d = np.bitwise_count(fps ^ fps[0]).astype(np.int16) if len(fps) else np.zeros(0, np.int16)
    order = np.argsort(d, kind="stable")
    fps, d = fps[order], d[order]
    n = len(fps)
    label = np.arange(n)
    for a in range(0, n, ROWS):
        rows = fps[a:a + ROWS, None]
        stop = int(np.searchsorted(d, d[min(n, a + ROWS) - 1] + distance, side="right"))
        for b in range(a, stop, COLUMNS):
            i, j = np.nonzero(np.bitwise_count(rows ^ fps[None, b:min(stop, b + COLUMNS)]) <= distance)
            label = merge_labels(label, a + i, b + j)
    moved = np.flatnonzero(label != np.arange(n))
    return fps[moved], fps[label[moved]]


def links(distinct: DataFrame, distance: int = 3, shard: int | None = None, sample: int = SAMPLE) -> DataFrame:
    """``a, b``: edges that connect exactly the fingerprints (column ``fp``, distinct longs)
    which chains of pairs within ``distance`` connect. ``shard``: members that a shard
    is planned for (``shard_size`` of their number unless given)."""
    total = distinct.count()
    share = min(sample, max(LEAST_SAMPLE, total // 10)) / max(1, total)
    unit = F.pmod(F.xxhash64("fp", F.lit("vantage")), F.lit(1 << 30)) / float(1 << 30)
    # A bounded sample (``sample`` expected) plans the tree.
    taken = distinct.where(unit < share).select("fp").toArrow()["fp"].to_numpy()
    tree = plan_tree(taken.astype(np.int64).view(np.uint64), total, distance, shard or shard_size(total))

    def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def down(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            s, m = route(np.concatenate(held).view(np.uint64), tree, distance)
            for a in range(0, len(s), 1 << 18):
                yield pa.record_batch([pa.array(s[a:a + (1 << 18)]), pa.array(m[a:a + (1 << 18)].view(np.int64))],
                                      names=["shard", "fp"])

        held, count = [], 0
        for batch in batches:       # gathered, since each call walks the whole tree
            held.append(batch.column(0).to_numpy())
            count += batch.num_rows
            if count >= ROUTED:
                yield from down(held)
                held, count = [], 0
        if count:
            yield from down(held)

    def linked(table: pa.Table) -> pa.Table:
        a, b = forest(np.unique(table["fp"].to_numpy().view(np.uint64)), distance)
        return pa.table({"a": pa.array(a.view(np.int64)), "b": pa.array(b.view(np.int64))})

    return (distinct.select("fp").mapInArrow(routed, "shard long, fp long")
            .groupBy("shard").applyInArrow(linked, "a long, b long"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    distance: int = 3) -> DataFrame:
    """``doc_id, fp, component_id`` for each row of ``docs``: the smallest id that chains of
    fingerprints within ``distance`` bits lead to.

    Equal fingerprints are one node, so copies never meet pairwise. Null and
    empty texts have fingerprint zero, linked like any other. Null ids take part but
    are never a component's id (a component of null ids only has a null one). Rows
    that repeat an id each get their text's result. An empty table gives an empty
    result; other columns are not read.
    """
    small_batches(docs.sparkSession)
    fps = written(docs.select(F.col(id_col).alias("doc_id"),
                              fingerprint_column(shingle)(F.col(text_col)).alias("fp")), "fingerprints")
    firsts = written(fps.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    found = connected_components(links(firsts.select("fp"), distance))
    rooted = firsts.join(found.select(F.col("node").alias("fp"), F.col("component").alias("root")), "fp", "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    labels = written(rooted.join(least, "root").select("fp", "component_id"), "labels")
    return fps.join(labels, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
             distance: int = 3) -> DataFrame:
    """``docs`` with one document of each near-duplicate group, that of the smallest id.
    Rows without an id stay; rows that repeat a kept id stay all."""
    found = near_duplicates(docs, id_col, text_col, shingle, distance)
    kept = found.where("doc_id = component_id").select(F.col("doc_id").alias(id_col)).distinct()
    has_id = F.col(id_col).isNotNull()
    return docs.where(has_id).join(kept, id_col, "left_semi").select(*columns_of(docs)).unionByName(docs.where(~has_id))
