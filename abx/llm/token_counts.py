"""Token counts of whole texts, as the tokenizer's own library gives them.

Long texts are encoded in chunks that overlap. Two neighbours are spliced where
both put a token boundary at the same character and that boundary is proven
stable: the splitting pattern of a byte-level vocabulary always ends a token
where white space follows something else, and where a run of letters ends,
whatever stands further left or right. Where an overlap holds no such place, it
is doubled, up to the rest of the text. An overlap is longer than any added token,
so that of two neighbours one sees such a token whole.

Texts and chunks are encoded by their units (``tokens``): the library encodes each
distinct unit once and its token count is kept. A chunk knows its token boundaries at the
ends of its units, which are stable places, and its tokens up to each.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abx.llm.runtime import slices, small_batches, worker_cache
from abx.llm.tokens import ODD, UNIT, known_units, library_units

CHUNK = 16_384      # characters
OVERLAP = 256
BATCH = 1 << 21     # characters whose units are looked up at once


def load(path: str):
    """(kind, tokenizer) of a vocabulary file, once per Python worker. ``splice`` tells
    that the boundaries above are proven for it; other kinds are encoded whole."""
    cache = worker_cache("tokenizers")
    if path not in cache:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"     # Spark's tasks are the parallelism
        if path.endswith(".model"):
            import sentencepiece
            cache[path] = ("sentencepiece", sentencepiece.SentencePieceProcessor(model_file=path), False)
        else:
            from tokenizers import Tokenizer
            with open(path, encoding="utf-8") as f:
                spec = json.load(f)
            pre = spec.get("pre_tokenizer") or {}
            splice = (pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
                      and not spec.get("normalizer") and not spec.get("post_processor")
                      and not any(len(t["content"]) >= OVERLAP or t["lstrip"] or t["rstrip"] or t["single_word"] or any(c.isspace() for c in t["content"])
                              or t["content"][:1].isalpha()
                                  for t in spec.get("added_tokens", [])))
            tokenizer = Tokenizer.from_file(path)
            tokenizer.no_truncation()
            tokenizer.no_padding()
            cache[path] = ("tokenizers", tokenizer, splice)
    return cache[path]


def stable_places(text: str, a: int, b: int) -> Iterator[int]:
    """Places p in (a, b) where a token ends whatever the context."""
    for p in range(a + 1, b):
        left, right = text[p - 1], text[p]
        if (right.isspace() and not left.isspace() and not "\x1c" <= right <= "\x1f") or (
                left.isalpha() and not right.isalpha()):
            yield p


class Counted:
    """A text's tokens by its units: their number, and how many end with each unit."""

    def __init__(self, units: list[str], counts: list[int]):
        self.ends, self.upto = np.cumsum(list(map(len, units))), np.cumsum(counts)

    def __len__(self) -> int:
        return int(self.upto[-1]) if len(self.upto) else 0

    def before(self, at: int) -> int | None:
        """Tokens before character ``at``, if a unit ends there."""
        k = int(np.searchsorted(self.ends, at))
        return int(self.upto[k]) if k < len(self.ends) and self.ends[k] == at else None


def _boundary(encoding, at: int) -> int | None:
    """The number of tokens before character ``at``, if a token starts there."""
    if isinstance(encoding, Counted):
        return encoding.before(at)
    k = encoding.char_to_token(at)
    if k is None or encoding.token_to_chars(k)[0] != at:
        return None
    while k > 0 and encoding.token_to_chars(k - 1)[0] == at:
        k -= 1
    return k


def count_spliced(text: str, encode, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """Tokens of one long text from its overlapping chunks, two of which are held at a time."""
    n = len(text)
    at, end = 0, min(n, chunk + overlap)
    here, skip, total = encode(text[at:end]), 0, 0     # skip: tokens that belong to the left neighbour
    while end < n:
        nxt, width = at + chunk, overlap
        while True:
            right_end = min(n, nxt + chunk + width)
            right = encode(text[nxt:right_end])
            if end < min(n, nxt + width):
                end = min(n, nxt + width)
                here = encode(text[at:end])
            if end == n:
                return total + len(here) - skip
            pairs = ((_boundary(here, p - at), _boundary(right, p - nxt)) for p in stable_places(text, nxt, end))
            found = next(((x, y) for x, y in pairs if x is not None and y is not None), None)
            if found:
                break
            width *= 2
        total += found[0] - skip
        here, skip, at, end = right, found[1], nxt, right_end
    return total + len(here) - skip


def count_texts(texts: list[str | None], path: str) -> list[int]:
    """Token counts of a batch; null counts as empty."""
    kind, tokenizer, splice = load(path)
    texts = [t or "" for t in texts]
    if kind == "sentencepiece":
        return [len(tokenizer.encode(t, num_threads=1)) for t in texts]
    def whole(s: str):
        return tokenizer.encode(s, add_special_tokens=False)

    if not splice:
        return [len(whole(t)) for t in texts]
    coder, cache = library_units(tokenizer), worker_cache("counts-" + path)

    def by_units(parts: list[str]) -> list:
        """``Counted`` of each part, or the library's own encoding where units do not hold."""
        units = [[] if ODD.search(t) else UNIT.findall(t) for t in parts]
        known = known_units(units, lambda fresh: [len(x) // 4 for x in coder(fresh)], cache)
        return [Counted(u, list(map(known.__getitem__, u))) if u or not t else whole(t) for u, t in zip(units, parts, strict=True)]

    out = [0] * len(texts)
    short = [i for i, t in enumerate(texts) if len(t) <= CHUNK + OVERLAP]
    for a, b in slices([texts[i] for i in short], BATCH):
        for i, e in zip(short[a:b], by_units([texts[i] for i in short[a:b]]), strict=True):
            out[i] = len(e)
    for i in set(range(len(texts))).difference(short):
        out[i] = count_spliced(texts[i], lambda s: by_units([s])[0], CHUNK, OVERLAP)
    return out


def with_token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                      limit: int = 512) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for each row of ``docs``.

    Null and empty texts have no tokens; repeated rows are counted alike; an empty
    table gives an empty result; other columns are not read. ``path`` names a
    vocabulary file that the workers can read.
    """
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = count_texts(batch.column(1).to_pylist(), path)
            yield pa.record_batch([batch.column(0), batch.column(2), pa.array(n, pa.int64())],
                                  names=["doc_id", "n_bytes", "n_tokens"])

    small_batches(docs.sparkSession)
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                       F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"))
    kind = base.schema["doc_id"].dataType.simpleString()
    return (base.mapInArrow(counted, f"doc_id {kind}, n_bytes long, n_tokens long")
            .withColumn("over_limit", F.col("n_tokens") > limit))
