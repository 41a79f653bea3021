"""Removal of word passages that earlier documents hold, by super-k-mer partitioning.

A window is ``window`` consecutive words. Its minimiser is the least hash among
its runs of ``GRAM`` words; consecutive windows that share it form a super-k-mer,
which travels as one packed string to the minimiser's bucket. Equal windows have
equal minimisers, so they meet there, and sorting (by doubling the length that
ranks stand for) tells equal windows apart exactly.

What need not travel does not: super-k-mers whose minimiser one document alone
has cannot repeat, and of equal super-k-mers only those of the smallest document
travel, the others being covered by it whole. Minimisers whose different super-k-mers
hold very many words send single windows instead, spread over sub-buckets by content;
a window that recurs within a document travels once, with all its places. What is known
to be covered goes on as spans without overlaps, dealt by document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from abx.llm.runtime import columns_of, free_name, slices, small_batches, texts_of, written

WINDOW = 50
GRAM = 5
BLOCK = 1 << 22         # bytes of text whose minimisers are computed at once
CHUNK_WORDS = 200_000   # words of a bucket that are sorted at once, at least
HOT = 150_000           # words in the different super-k-mers of a minimiser beyond which it is split
KINDS = {"tinyint": pa.int8(), "smallint": pa.int16(), "int": pa.int32(), "bigint": pa.int64(), "string": pa.string()}


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(29))


def minimisers(hashes: np.ndarray, window: int) -> np.ndarray:
    """For each window of word hashes, the least of its gram hashes, by doubling."""
    n = len(hashes)
    grams = np.zeros(max(0, n - GRAM + 1), np.uint64)
    for k in range(GRAM):
        grams = _mixed(grams * np.uint64(0x9E3779B97F4A7C15) + hashes[k:k + len(grams)])
    span, low = 1, grams
    width = window - GRAM + 1
    while 2 * span <= width:
        low = np.minimum(low[:len(low) - span], low[span:])
        span *= 2
    rest = width - span
    return np.minimum(low[:len(low) - rest], low[rest:]) if rest else low


def super_kmers(text: bytes, window: int, words: list[bytes] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, number of windows and minimiser of each super-k-mer of a text's words."""
    words = text.split() if words is None else words
    if len(words) < window:
        z = np.zeros(0, np.int64)
        return z, z, z
    m = minimisers(np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words)), window).view(np.int64)
    starts = np.concatenate(([0], np.flatnonzero(m[1:] != m[:-1]) + 1))
    return starts, np.diff(np.append(starts, len(m))), m[starts]


def repeated_spans(packed: list[tuple[int, int, int, list[bytes]]], window: int) -> list[tuple[int, int, int]]:
    """Of super-k-mers (document, start, windows, words): the spans of words (row of
    ``packed``, start, length) that windows cover which also occur under a smaller document."""
    ids: dict[bytes, int] = {}
    rank = np.array([ids.setdefault(w, len(ids)) for _, _, _, words in packed for w in words], np.int64)
    firsts = np.cumsum([0, *(len(words) for _, _, _, words in packed)])
    span = 1
    while span < window:        # rank[i] names the run of ``span`` words from i on
        step = min(span, window - span)
        pairs = np.zeros(len(rank), np.int64)
        pairs[:len(rank) - step] = rank[step:]
        rank = np.unique((rank << 32) | pairs, return_inverse=True)[1]
        span += step
    count = np.array([n for _, _, n, _ in packed], np.int64)
    row = np.repeat(np.arange(len(packed)), count)
    within = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    name = rank[firsts[row] + within]
    doc = np.array([d for d, _, _, _ in packed])[row]
    order = np.lexsort((doc, name))
    lead = np.flatnonzero(np.concatenate(([True], name[order][1:] != name[order][:-1])))
    least = np.empty(len(row), doc.dtype)
    least[order] = np.repeat(doc[order][lead], np.diff(np.append(lead, len(row))))
    hit = np.flatnonzero(doc > least)
    if not len(hit):
        return []
    cut = np.concatenate(([True], (np.diff(hit) != 1) | (np.diff(row[hit]) != 0)))
    a = np.flatnonzero(cut)
    length = np.diff(np.append(a, len(hit)))
    return [(int(row[h]), packed[row[h]][1] + int(within[h]), int(k) + window - 1) for h, k in zip(hit[a], length)]


def merged(places: list[int], length: int) -> list[tuple[int, int]]:
    """The words that runs of ``length`` from ``places`` on cover, as (start, length) without overlaps."""
    at = np.unique(np.array(places, np.int64))
    cut = np.flatnonzero(np.diff(at) > length) + 1
    a, b = at[np.concatenate(([0], cut))], at[np.concatenate((cut - 1, [len(at) - 1]))]
    return list(zip(a.tolist(), (b - a + length).tolist()))


def cut_spans(text: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, int, int]:
    """The text without the words in ``spans`` (start, length), each removed with the white
    space up to the next word; its number of words, and how many were removed."""
    words = text.split()
    gone = np.zeros(len(words) + 1, np.int64)
    for a, n in spans:
        gone[a] += 1
        gone[min(len(words), a + n)] -= 1
    gone = np.cumsum(gone)[:len(words)] > 0
    if not gone.any():
        return text, len(words), 0
    edges = np.flatnonzero(np.diff(np.concatenate(([False], gone, [False])).astype(np.int8)))
    # Byte places of the words where a removed run begins or ends.
    out, at, k = [], 0, 0
    for a, b in edges.reshape(-1, 2):
        while k < a:
            at = text.index(words[k], at) + len(words[k])
            k += 1
        begin = text.index(words[a], at)
        out.append((begin, a))
        while k < b:
            at = text.index(words[k], at) + len(words[k])
            k += 1
        out.append((text.index(words[b], at) if b < len(words) else len(text), b))
    places = [0, *(p for p, _ in out), len(text)]
    return b"".join(text[places[i]:places[i + 1]] for i in range(0, len(places), 2)), len(words), int(gone.sum())


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """``docs`` with all their columns, repeated passages cut from the text, and two more
    columns ``n_words`` and ``n_removed`` (lengthened where the names are taken).

    Null texts stay null and have no words. Rows without an id neither lose nor cause
    removals. Rows that share an id count as one document; none removes words of the
    other. An empty table gives an empty result. Texts in which nothing is removed are
    unchanged. Ids are integers or strings; other types are an error.
    """
    small_batches(docs.sparkSession)
    id_type = docs.schema[id_col].dataType
    kind = id_type.simpleString()
    if kind not in KINDS:
        raise ValueError(f"ids of type {kind}: cast them to an integer or a string")
    to_arrow = KINDS[kind]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, ids, keys = texts_of(batch.column(1)), batch.column(0), batch.column(2)
            for a, b in slices(texts, BLOCK):
                row, start, n, m, digest = [], [], [], [], []
                for i in range(a, b):
                    words = texts[i].split()
                    s, k, x = super_kmers(b"", window, words)
                    row += [i] * len(s)
                    start.append(s)
                    n.append(k)
                    m.append(x)
                    digest += [xxhash.xxh3_128_digest(b" ".join(words[p:p + q + window - 1])) for p, q in zip(s, k)]
                two = np.frombuffer(b"".join(digest), "<i8").reshape(-1, 2)
                at = pa.array(row, pa.int64())
                yield pa.record_batch(
                    [ids.take(at), keys.take(at), pa.array(np.concatenate(start), pa.int32()),
                     pa.array(np.concatenate(n), pa.int32()), pa.array(np.concatenate(m), pa.int64()),
                     pa.array(two[:, 0]), pa.array(two[:, 1])], names=["doc", "k", "start", "n", "m", "d1", "d2"])

    text_key = F.xxhash64(text_col)     # with the id, it tells rows apart
    base = docs.where(F.col(id_col).isNotNull() & (F.length(text_col) >= 2 * window - 1)).select(
        F.col(id_col).alias("doc"), F.col(text_col).alias("text"), text_key.alias("k"))
    kmers = written(base.mapInArrow(scan, f"doc {kind}, k long, start int, n int, m long, d1 long, d2 long"), "kmers")
    shared = kmers.groupBy("m").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi")).where("lo < hi").select("m")
    found = written(kmers.join(shared, "m", "left_semi"), "shared")
    first = found.groupBy("m", "d1", "d2").agg(F.min("doc").alias("first"))
    # Rows that repeat an id and its text tell the same: one of them is enough from here on.
    told = written(found.join(first, ["m", "d1", "d2"]).select(
        "doc", "k", "start", "n", "m", (F.col("doc") > F.col("first")).alias("copy")).distinct(), "told")
    # Different super-k-mers of a minimiser, of all its documents; hot ones are split.
    words = F.sum(F.col("n").cast("long") + window - 1)
    sizes = (told.where("not copy").groupBy("m").agg(words.alias("words"), F.sum("n").alias("windows"),
                                                     F.min("doc").alias("lo"), F.max("doc").alias("hi"))
             .where("lo < hi").select("m", F.when(F.col("words") > HOT, F.ceil(F.col("windows") * window / HOT)).otherwise(0)
                                      .cast("int").alias("subs")))
    travel = (told.where("not copy").join(sizes, "m").groupBy("doc", "k")
              .agg(F.collect_list(F.struct("start", "n", "m", "subs")).alias("wanted")))

    # All columns ride along; the text is compressed for the one shuffle that brings rows to their spans.
    z, doc, key = (free_name(docs, c) for c in ("_z", "_doc", "_k"))
    i_text = docs.columns.index(text_col)

    def press(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            yield pa.record_batch(
                [pa.array([None if t is None else c.compress(t) for t in texts_of(x)], pa.binary()) if i == i_text else x
                 for i, x in enumerate(batch.columns)], names=batch.schema.names)

    pressed_schema = T.StructType(
        [T.StructField(z if f.name == text_col else f.name, T.BinaryType() if f.name == text_col else f.dataType)
         for f in docs.schema] + [T.StructField(doc, id_type), T.StructField(key, T.LongType())])
    pressed = docs.select(*columns_of(docs), F.col(id_col).alias(doc), text_key.alias(key)).mapInArrow(press, pressed_schema)

    places = pa.list_(pa.int32())
    packed_schema = f"m long, s int, doc {kind}, k long, start int, n int, packed binary, also array<int>"

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["m", "s", "doc", "k", "start", "n", "packed", "also"]
        kinds = [pa.int64(), pa.int32(), to_arrow, pa.int64(), pa.int32(), pa.int32(), pa.binary(), places]
        d = zstandard.ZstdDecompressor()
        rows: list[tuple] = []
        seen: dict[bytes, tuple] = {}       # single windows; the last column lists more places in the document
        covered: dict[tuple, list[int]] = {}    # places of windows that a smaller document holds

        def drained() -> pa.RecordBatch:
            for (doc_, k_), at in covered.items():
                rows.extend((k_, -1, doc_, k_, a, n - window + 1, None, None) for a, n in merged(at, window))
            covered.clear()
            out = pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, *seen.values()), kinds)], names=names)
            rows.clear()
            seen.clear()
            return out

        for batch in batches:
            size = 0
            for doc_, k_, z_, wanted in zip(*(batch.column(c).to_pylist() for c in range(4))):
                words = d.decompress(z_).split()
                for w in wanted:
                    start, n, m, subs = w["start"], w["n"], w["m"], w["subs"]
                    if not subs:
                        rows.append((m, 0, doc_, k_, start, n, b" ".join(words[start:start + n + window - 1]), None))
                        size += len(rows[-1][6])
                    for p in range(start, start + n) if subs else ():
                        one = b" ".join(words[p:p + window])
                        # Of equal single windows in a batch the smallest document's travels.
                        old = seen.get(one)
                        if old and old[2] == doc_ and old[3] == k_:
                            old[7].append(p)
                            size += 8
                            continue
                        row = (m, xxhash.xxh64_intdigest(one) % subs, doc_, k_, p, 1, one, [])
                        if old is None:
                            seen[one] = row
                        elif old[2] < doc_:
                            covered.setdefault((doc_, k_), []).append(p)
                            size += 8
                            continue
                        elif old[2] > doc_:
                            covered.setdefault(old[2:4], []).extend((old[4], *old[7]))
                            seen[one] = row
                        else:
                            rows.append(row)
                        size += 64 + len(one)
                        if size > BLOCK:
                            yield drained()
                            size = 0
                    if size > BLOCK:
                        yield drained()
                        size = 0
            if rows or seen:
                yield drained()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def spans(held: list[tuple]) -> pa.RecordBatch:
            found = repeated_spans([(h[2], h[4], h[5], h[6].split(b" ")) for h in held], window) if held else []
            out, single = [], {}        # single windows come with all their places
            for r, a, n in found:
                h = held[r]
                if h[7] is None:
                    out.append((h[2], h[3], a, n))
                else:
                    single.setdefault(h[2:4], []).extend((a, *h[7]))
            return record(out + [(*who, a, n) for who, at in single.items() for a, n in merged(at, window)])

        def record(out: list[tuple]) -> pa.RecordBatch:
            cols = list(zip(*out)) or [()] * 4
            return pa.record_batch([pa.array(c, t) for c, t in zip(cols, (to_arrow, pa.int64(), pa.int32(), pa.int32()))],
                                   names=["doc", "k", "start", "length"])

        held, words = [], 0
        for batch in batches:
            known = []
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[6] is None:
                    known.append((*row[2:5], row[5] + window - 1))
                    continue
                if words >= CHUNK_WORDS and row[:2] != held[-1][:2]:
                    yield spans(held)
                    held, words = [], 0
                held.append(row)
                words += row[5] + window - 1
            if known:
                yield record(known)
        yield spans(held)

    wish = free_name(docs, "_wanted")
    asked = travel.select(F.col("doc").alias(doc), F.col("k").alias(key), F.col("wanted").alias(wish))
    moved = (pressed.select(doc, key, z).dropDuplicates([doc, key]).join(asked, [doc, key])
             .select(doc, key, z, wish)
             .mapInArrow(unpack, packed_schema)
             .repartition("m", "s").sortWithinPartitions("m", "s")
             .mapInArrow(count, f"doc {kind}, k long, start int, length int"))
    copies = told.where("copy").select("doc", "k", "start", (F.col("n") + window - 1).cast("int").alias("length"))
    spans = (moved.unionByName(copies).groupBy(F.col("doc").alias(doc), F.col("k").alias(key))
             .agg(F.collect_set(F.struct("start", "length")).alias("_spans")))
    out_names = [*docs.columns, free_name(docs, "n_words"), free_name(docs, "n_removed")]
    cuts = free_name(docs, "_spans")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d = zstandard.ZstdDecompressor()
        for batch in batches:
            cols = batch.columns
            texts, total, lost = [], [], []
            for t, s in zip(cols[i_text].to_pylist(), cols[-1].to_pylist()):
                if t is None:
                    got = (None, 0, 0)
                else:
                    got = cut_spans(d.decompress(t), [(x["start"], x["length"]) for x in s or ()])
                texts.append(got[0])
                total.append(got[1])
                lost.append(got[2])
            yield pa.record_batch(
                [pa.array(texts, pa.binary()).cast(pa.string()) if i == i_text else x for i, x in enumerate(cols[:-1])]
                + [pa.array(total, pa.int64()), pa.array(lost, pa.int64())],
                names=out_names)

    joined = pressed.join(spans.withColumnRenamed("_spans", cuts), [doc, key], "left").drop(doc, key)
    out_schema = T.StructType([T.StructField(f.name, f.dataType) for f in docs.schema]
                              + [T.StructField(c, T.LongType()) for c in out_names[-2:]])
    return joined.mapInArrow(cut, out_schema)
