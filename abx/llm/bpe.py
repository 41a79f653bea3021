"""Byte-level BPE encoding and decoding with a pair occurrence index.

The distinct words of a batch are laid out in one row of symbols. An index maps
each pair of neighbours to all its positions; the ranks of pairs that occur are
active and are applied in ascending order, each at all its positions from left to
right, and a merge updates the position lists of the pairs beside it. Every merge
ranks above those that made its parts (checked when a vocabulary is loaded), so
one ascending pass gives each word what merging it alone would give.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abx.llm.runtime import small_batches, worker_cache
from abx.llm.tokens import encode_all

# Fixed value: the pattern by which byte-level vocabularies of this kind split text into words.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
DECODE_TOKENS = 1 << 18     # decoded at once


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary:
    printable Latin-1 stands for itself, the others count up from U+0100."""
    keep = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    out, extra = [], 0
    for b in range(256):
        out.append(chr(b if b in keep else 0x100 + extra))
        extra += b not in keep
    return out


@dataclass(frozen=True)
class Vocabulary:
    byte_ids: np.ndarray
    merges: list[tuple[int, int, int]]      # by rank: first, second, merged id
    pairs: np.ndarray                       # sorted codes of the pairs, and the rank of each
    pair_ranks: np.ndarray
    words: "re.Pattern"
    added: dict[str, int]
    added_split: "re.Pattern | None"
    token_at: np.ndarray        # start of each id's bytes in ``blob``, one more at the end
    blob: np.ndarray

    def ranks(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """The rank of each pair, -1 where none is merged."""
        code = (first << 32) | second
        k = np.minimum(np.searchsorted(self.pairs, code), len(self.pairs) - 1)
        return np.where(self.pairs[k] == code, self.pair_ranks[k], -1)


def read_vocabulary(path: str) -> Vocabulary:
    """A byte-level ``.json`` vocabulary without normalizer, post-processor or prefix space."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    pre, model = spec["pre_tokenizer"] or {}, spec["model"]
    if (model["type"] != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or spec["normalizer"]
            or spec["post_processor"] or model.get("ignore_merges") or model.get("dropout")):
        raise ValueError(f"{path} is not a plain byte-level BPE vocabulary")
    ids, symbols = model["vocab"], byte_symbols()
    made: dict[int, int] = {}
    merges: list[tuple[int, int, int]] = []
    for rank, pair in enumerate(model["merges"]):
        a, b = pair.split(" ") if isinstance(pair, str) else pair
        new = ids[a + b]
        if new in made or max(made.get(ids[a], -1), made.get(ids[b], -1)) >= rank:
            raise ValueError("a merge does not rank above those that make its parts")
        made[new] = rank
        merges.append((ids[a], ids[b], new))
    back = {s: b for b, s in enumerate(symbols)}
    added = {t["content"]: t["id"] for t in spec["added_tokens"]}
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] or any(c.isspace() for c in t["content"])
           or t["content"][:1].isalpha() for t in spec["added_tokens"]):
        raise ValueError("added tokens with options are not supported")
    table = [b""] * (max([*ids.values(), *added.values()]) + 1)
    for s, i in [*ids.items(), *added.items()]:
        table[i] = bytes(back[c] for c in s) if all(c in back for c in s) else s.encode()
    # Longer added tokens first: the longest that fits is taken.
    split = "|".join(re.escape(s) for s in sorted(added, key=len, reverse=True))
    codes = np.array([(a << 32) | b for a, b, _ in merges] or [-1], np.int64)
    order = np.argsort(codes)
    return Vocabulary(np.array([ids[s] for s in symbols], np.int64), merges, codes[order], order, regex.compile(PATTERN), added,
                      re.compile(f"({split})") if split else None,
                      np.cumsum([0, *map(len, table)]), np.frombuffer(b"".join(table), np.uint8))


def merge_words(words: list[bytes], v: Vocabulary) -> list[bytes]:
    """The ids of each word (int32 as bytes), by one ascending pass over the active ranks.
    All occurrences of a rank are merged at once."""
    size = np.array([len(w) for w in words], np.int64)
    symbol = v.byte_ids[np.frombuffer(b"".join(words), np.uint8)]   # by position; -1 where a merge took it
    ends = np.cumsum(size)
    left, right = np.arange(-1, len(symbol) - 1), np.arange(1, len(symbol) + 1)
    left[(ends - size)[size > 0]] = -1
    right[(ends - 1)[size > 0]] = -1
    index: dict[int, list[int]] = {}        # rank of a pair -> positions of its first symbol

    def occur(at: np.ndarray) -> None:
        ranks = v.ranks(symbol[at], symbol[right[at]])
        hit = np.flatnonzero(ranks >= 0)
        if not len(hit):
            return
        hit = hit[np.argsort(ranks[hit], kind="stable")]
        ranks, places = ranks[hit], at[hit].tolist()
        heads = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
        a = 0
        for rank, b in zip(ranks[np.concatenate(([0], heads))].tolist(), [*heads.tolist(), len(places)]):
            known = index.get(rank)
            if known is None:
                index[rank] = places[a:b]
                heapq.heappush(active, rank)
            else:
                known += places[a:b]
            a = b

    active: list[int] = []
    occur(np.flatnonzero(right >= 0))
    while active:
        rank = heapq.heappop(active)
        first, second, new = v.merges[rank]
        at = np.unique(index.pop(rank))
        after = right[at]
        # A merge of lower rank may have used a place since it was noted.
        still = (symbol[at] == first) & (after >= 0) & (symbol[after] == second)
        at, after = at[still], after[still]
        if first == second and len(at) > 1:     # a run of one symbol pairs off from the left
            keep, taken = [], set()
            for k, (i, j) in enumerate(zip(at.tolist(), after.tolist())):
                if i not in taken:
                    keep.append(k)
                    taken.add(j)
            at, after = at[keep], after[keep]
        if not len(at):
            continue
        beyond = right[after]
        symbol[at], symbol[after], right[at] = new, -1, beyond
        inside = beyond >= 0
        left[beyond[inside]] = at[inside]
        before = left[at]
        occur(np.concatenate((before[before >= 0], at[inside])))
    alive = np.concatenate(([0], np.cumsum(symbol >= 0)))
    data = symbol[symbol >= 0].astype("<i4").tobytes()
    cut = (4 * alive[np.concatenate(([0], ends))]).tolist()
    return [data[x:y] for x, y in zip(cut, cut[1:])]


def encode_units(units: list[str], v: Vocabulary) -> list[bytes]:
    """Ids (int32 as bytes) of texts that are encoded by themselves: added tokens are cut
    out, the rest is split into words, and the distinct words are merged together."""
    if v.added_split and v.added_split.search("\n".join(units)):
        split = [list(chain.from_iterable([part] if k % 2 else v.words.findall(part)
                                          for k, part in enumerate(v.added_split.split(u)))) for u in units]
    else:
        split = list(map(v.words.findall, units))
    words = list(set(chain.from_iterable(split)).difference(v.added))
    ids = dict(zip(words, merge_words([w.encode() for w in words], v)))
    ids.update({w: np.array([i], "<i4").tobytes() for w, i in v.added.items()})
    return [b"".join(map(ids.__getitem__, u)) for u in split]


def decode_ids(ids: np.ndarray, v: Vocabulary) -> bytes:
    """The bytes of a row of ids; special tokens stand as text."""
    out = []
    for a in range(0, len(ids), DECODE_TOKENS):
        part = ids[a:a + DECODE_TOKENS]
        size = v.token_at[part + 1] - v.token_at[part]
        ends = np.cumsum(size)
        at = np.arange(ends[-1]) + np.repeat(v.token_at[part] - (ends - size), size)
        out.append(v.blob[at].tobytes())
    return b"".join(out)


def encode_texts(texts: list[str | None], path: str) -> list[np.ndarray]:
    """Ids of each whole text; null counts as empty."""
    vocabularies = worker_cache("bpe")
    if path not in vocabularies:
        vocabularies[path] = read_vocabulary(path)
    v = vocabularies[path]
    found = encode_all([t or "" for t in texts], lambda units: encode_units(units, v), worker_cache("bpe-" + path))
    return [np.frombuffer(x, "<i4") for x in found]


def encode_decode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids array<int>, decoded string`` for each row of ``docs``.

    ``decoded`` is made from the ids. Null and empty texts have no ids and decode to
    the empty text; repeated rows are encoded alike; an empty table gives an empty
    result; other columns are not read. Bytes that are no UTF-8 decode to U+FFFD.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            # Slices keep the ids and decoded texts of one output batch small.
            for a in range(0, len(texts), 512):
                ids = encode_texts(texts[a:a + 512], path)
                v = worker_cache("bpe")[path]
                flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
                offsets = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                yield pa.record_batch(
                    [batch.column(0).slice(a, 512), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32())),
                     pa.array([decode_ids(x, v).decode("utf-8", "replace") for x in ids], pa.string())],
                    names=["doc_id", "ids", "decoded"])

    small_batches(docs.sparkSession)
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = base.schema["doc_id"].dataType.simpleString()
    return base.mapInArrow(run, f"doc_id {kind}, ids array<int>, decoded string")
