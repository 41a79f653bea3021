"""Best-fit packing by exact-complement hashing.

Documents are cut into pieces of at most ``size`` tokens and packed into sequences
of ``size``. The plan needs only how many pieces each length has (at most ``size``
numbers): lengths that complete each other exactly, singly, in pairs or in triples
found through an index of their sums, are consumed as far as their counts go, and
what is left is placed best fit. The plan gives each length's pieces, in rank
order, runs of sequences; pieces find their place from their rank, which Spark
computes within (length, bucket).
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from abx.llm.runtime import small_batches, worker_cache, written
from abx.llm.token_counts import load
from abx.llm.tokens import encode_all, library_units

END_ID = 0              # ends each document
ROWS_PER_BUCKET = 50_000    # of pieces that one window ranks


@dataclass(frozen=True)
class Run:
    """``bins`` sequences from ``first`` on take ``each`` pieces of ``length`` at ``offset``;
    the pieces are those ranked from ``rank`` on."""

    length: int
    rank: int
    bins: int
    each: int
    first: int
    offset: int


class _Sums:
    """Index of the lengths in use by their sums, singly, in pairs and in triples: how many
    have each sum, equal lengths in one pair or triple included. A length that leaves
    takes its pairs and triples along."""

    def __init__(self, lengths: Iterable[int], size: int):
        self.end = size + 1
        self.one, twice, thrice = np.zeros((3, self.end), np.int64)
        for n in lengths:
            for k, at in enumerate((self.one, twice, thrice), 1):
                at[k * n:k * n + 1] = 1
        both = np.convolve(self.one, self.one)[:self.end]
        self.two = (both + twice) // 2
        self.three = (np.convolve(both, self.one)[:self.end] + 3 * np.convolve(twice, self.one)[:self.end] + 2 * thrice) // 6

    def drop(self, n: int) -> None:
        if self.one[n]:
            self.one[n] = 0
            for k, (sums, rest) in enumerate(((self.two, self.one), (self.three, self.two))):
                sums[n:] -= rest[:self.end - n]
                if k:
                    sums[2 * n:] -= self.one[:max(0, self.end - 2 * n)]
                sums[(k + 2) * n:(k + 2) * n + 1] -= 1

    def pairs(self, total: int) -> list[int]:
        """The larger lengths of the pairs of this sum, longest first."""
        if not self.two[total]:
            return []
        a = np.arange(total - 1, (total - 1) // 2, -1)
        return a[(self.one[a] & self.one[total - a]) > 0].tolist()

    def triples(self, total: int) -> Iterator[tuple[int, int]]:
        """The two larger lengths of the triples of this sum, longest first."""
        if self.three[total]:
            a = np.arange(total - 2, (total - 1) // 3, -1)
            for x in a[(self.one[a] > 0) & (self.two[total - a] > 0)].tolist():
                yield from ((x, y) for y in self.pairs(total - x) if y <= x)


class _Plan:
    def __init__(self, counts: dict[int, int], size: int):
        self.left = {n: c for n, c in counts.items() if c > 0}
        self.used = dict.fromkeys(self.left, 0)
        self.size, self.bins, self.runs = size, 0, []
        self.sums = _Sums(self.left, size)

    def take(self, length: int, bins: int, each: int, first: int, offset: int) -> None:
        self.runs.append(Run(length, self.used[length], bins, each, first, offset))
        self.used[length] += bins * each
        self.left[length] -= bins * each
        if not self.left[length]:
            del self.left[length]
            self.sums.drop(length)

    def fill(self, lengths: tuple[int, ...]) -> None:
        """As many new sequences of exactly these lengths as their counts allow."""
        kinds = {n: lengths.count(n) for n in lengths}
        bins = min(self.left[n] // k for n, k in kinds.items())
        offset = 0
        for n, k in kinds.items():
            self.take(n, bins, k, self.bins, offset)
            offset += n * k
        self.bins += bins

    def has(self, *lengths: int) -> bool:
        return all(self.left.get(n, 0) >= lengths.count(n) for n in lengths)

    def complement(self, big: int) -> tuple[int, ...] | None:
        """One, two or three lengths, none above ``big``, that fill its gap exactly."""
        gap = self.size - big
        if gap == 0:
            return ()
        if gap <= big and self.has(big, gap):
            return (gap,)
        for a in self.sums.pairs(gap):
            if self.has(big, a, gap - a):
                return (a, gap - a)
        for a, b in self.sums.triples(gap):
            if self.has(big, a, b, gap - a - b):
                return (a, b, gap - a - b)
        return None


def plan_packing(counts: dict[int, int], size: int) -> tuple[list[Run], int]:
    """Runs that place every piece, and how many sequences they fill. Works on counts
    per length, so its time does not grow with the number of pieces."""
    p = _Plan(counts, size)
    for big in sorted(p.left, reverse=True):
        while p.left.get(big):
            found = p.complement(big)
            if found is None:
                break
            p.fill((big, *found))
        p.sums.drop(big)        # no later sequence takes it as a part
    # Best fit of the rest, longest first: open sequences are kept as groups (gap, first, bins).
    groups: list[tuple[int, int, int]] = []
    for n in sorted(p.left, reverse=True):
        while p.left.get(n):
            at = bisect_left(groups, (n, -1, -1))
            if at < len(groups):
                gap, first, bins = groups.pop(at)
                each = 1 if gap // n == 1 or p.left[n] < bins else min(gap // n, p.left[n] // bins)
                use = min(bins, p.left[n])
                if use < bins:
                    insort(groups, (gap, first + use, bins - use))
            else:
                each = min(size // n, p.left[n])
                use, gap, first = p.left[n] // each, size, p.bins
                p.bins += use
            p.take(n, use, each, first, size - gap)
            if gap - n * each:
                insort(groups, (gap - n * each, first, use))
    return p.runs, p.bins


def pieces_of(docs: DataFrame, path: str, size: int = 2048, id_col: str = "doc_id", text_col: str = "text",
              with_ids: bool = False) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32`` (and ``ids``).

    A document is its text's ids and ``END_ID``. Longer ones than ``size`` are cut so
    that all pieces but the first are full. Null text counts as empty.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, tokenizer, by_units = load(path)
        encode = library_units(tokenizer)
        cache = worker_cache("ids-" + path)
        end = np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            row, piece, start, length, crc, ids = [], [], [], [], [], []
            texts = [t or "" for t in batch.column(1).to_pylist()]
            coded = encode_all(texts, encode, cache) if by_units else encode(texts)
            for i, data in enumerate(coded):
                data += end
                n = len(data) // 4
                a, k = 0, 0
                while a < n:
                    b = a + ((n - a - 1) % size + 1 if k == 0 else size)
                    part = data[4 * a:4 * b]
                    row.append(i)
                    piece.append(k)
                    start.append(a)
                    length.append(b - a)
                    crc.append(zlib.crc32(part))
                    if with_ids:
                        ids.append(np.frombuffer(part, "<u4").astype(np.int32))
                    a, k = b, k + 1
            columns = [batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
                       pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                columns, names = [*columns, pa.array(ids, pa.list_(pa.int32()))], [*names, "ids"]
            yield pa.record_batch(columns, names=names)

    small_batches(docs.sparkSession)
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = base.schema["doc_id"].dataType.simpleString()
    return base.mapInArrow(cut, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long"
                           + (", ids array<int>" if with_ids else ""))


def pack(pieces: DataFrame, size: int = 2048) -> DataFrame:
    """``pieces`` (as ``pieces_of`` gives them, with a ``length`` of at most ``size``) with
    ``sequence_id`` and ``offset``.

    Pieces are ranked within length by a hash bucket of their document and piece, so a
    length that a third of all pieces share is ranked in many tasks. Repeated rows
    are packed each; an empty table gives an empty result.
    """
    taken = written(pieces, "pieces")
    counts = {r.length: r.n for r in taken.groupBy("length").agg(F.count("*").alias("n")).collect()}  # size rows at most
    runs, _ = plan_packing(counts, size)
    buckets = max(1, sum(counts.values()) // ROWS_PER_BUCKET)
    salted = taken.withColumn("_b", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)).cast("int"))
    before = Window.partitionBy("length").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    shift = (salted.groupBy("length", "_b").agg(F.count("*").alias("n"))
             .select("length", "_b", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_shift")))
    within = Window.partitionBy("length", "_b").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = (salted.withColumn("_r", F.row_number().over(within).cast("long") - 1).join(shift, ["length", "_b"])
              .select(*taken.columns, (F.col("_r") + F.col("_shift")).alias("_rank")))
    # The plan's size is bounded by the number of lengths, not of pieces: it travels with the task.
    by_length: dict[int, np.ndarray] = {}
    for r in runs:
        by_length.setdefault(r.length, []).append((r.rank, r.bins, r.each, r.first, r.offset))
    tables = {n: np.array(v, np.int64) for n, v in by_length.items()}
    shared = pieces.sparkSession.sparkContext.broadcast(tables)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = shared.value
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("_rank").to_numpy()
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for n in np.unique(length):
                at = np.flatnonzero(length == n)
                t = tables[int(n)]
                run = t[np.searchsorted(t[:, 0], rank[at], side="right") - 1]
                k = rank[at] - run[:, 0]
                sequence[at] = run[:, 3] + k // run[:, 2]
                offset[at] = run[:, 4] + (k % run[:, 2]) * n
            yield pa.record_batch([*batch.columns[:-1], pa.array(sequence), pa.array(offset)],
                                  names=[*batch.schema.names[:-1], "sequence_id", "offset"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in taken.schema)
    return ranked.mapInArrow(place, f"{schema}, sequence_id long, offset long")
