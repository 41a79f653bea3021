"""Personal data: spans that patterns find, and spans that a character model adds.

The patterns run over whole texts in time linear in them. The model is a
bidirectional LSTM with CRF transitions (``tagger``), trained on windows around labelled spans
and around look-alikes. What it adds must hold a value of its kind (a
Luhn checksum, numbers up to 255, enough digits) and must not touch a letter or digit:
so it finds data in forms and places that the patterns miss or give up on.
"""

from __future__ import annotations

import hashlib
import io
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from abx.llm import tagger
from abx.llm.runtime import small_batches, written

KINDS = ("email", "ip", "card", "phone")
SPANS = "array<struct<kind:string,start:int,end:int>>"

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]*\Z")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_CHAIN = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NUMBER = re.compile(r"[0-9]+")


@dataclass(frozen=True)
class Sampling:
    """Bounds of what the model learns from: about ``docs`` texts, of those at most
    ``per_kind`` windows of ``width`` characters for each kind, for look-alikes and for other places."""

    docs: int = 40_000
    per_kind: int = 500
    width: int = 80


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) << (i & 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done = 0
    at = text.find("@")
    while at >= 0:
        a = at
        while a > done and text[a - 1] in _LOCAL:
            a -= 1
        domain = _DOMAIN.match(text, at + 1) if a < at else None
        if domain:
            done = domain.end()
            yield a, done
        at = text.find("@", max(at + 1, done))


def _addresses(text: str) -> Iterator[tuple[int, int, bool]]:
    """Four numbers joined by dots, counted off from the start of each chain of them."""
    for chain in _CHAIN.finditer(text):
        parts = list(_NUMBER.finditer(text, *chain.span()))
        for k in range(0, len(parts) - 3, 4):
            yield parts[k].start(), parts[k + 3].end(), all(_at_most_255(p[0]) for p in parts[k:k + 4])


def _at_most_255(number: str) -> bool:
    number = number.lstrip("0")
    return len(number) < 4 and int(number or 0) <= 255


def base_spans(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int]]]:
    """Spans (kind number, start, end) that the patterns find, leftmost and without
    overlap within a kind, by start and kind; and look-alikes: matches that fail their check."""
    spans, failed = [(0, a, b) for a, b in _emails(text)], []
    for a, b, good in _addresses(text):
        if good:
            spans.append((1, a, b))
        else:
            failed.append((a, b))
    for m in _DIGITS.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            spans.append((2, *m.span()))
        elif len(digits) >= 6:
            failed.append(m.span())
    for m in _PHONE.finditer(text):
        if 9 <= sum(map(len, _NUMBER.findall(m[0]))) <= 15:
            spans.append((3, *m.span()))
        else:
            failed.append(m.span())
    return sorted(spans, key=lambda s: (s[1], s[0])), failed


_AT = re.compile(r"\s?(?:[(\[{]at[)\]}]|@)\s?", re.I)
_DOT = re.compile(r"\s?[(\[{](?:dot|\.)[)\]}]\s?", re.I)
_MAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")


def holds_value(kind: int, s: str) -> bool:
    """Whether a span that the model proposes holds a value of its kind, in whatever notation."""
    if kind == 0:
        return bool(_MAIL.fullmatch(_DOT.sub(".", _AT.sub("@", s))))
    digits = "".join(_NUMBER.findall(s))
    if not s or s[-1] not in "0123456789" or re.search(r"[^0-9 ()+./-]", s):
        return False
    if kind == 1:
        parts = _NUMBER.findall(s)
        return s[0] in "0123456789" and len(parts) == 4 and all(map(_at_most_255, parts))
    if kind == 2:
        return s[0] in "0123456789" and 12 <= len(digits) <= 19 and luhn(digits)
    return 9 <= len(digits) <= 15 and len(digits) < len(s)


_MARK = re.compile(r"[0-9@]|[(\[{]at[)\]}]", re.I)


def marks(text: str) -> np.ndarray:
    """Places of digits, of @ and of what stands for it: every span that ``holds_value`` has one."""
    return np.array([m.start() for m in _MARK.finditer(text)], np.int64)


def valued_parts(kind: int, s: str) -> Iterator[tuple[int, int]]:
    """The whole of a proposed span if it holds a value of its kind, else the longest of its parts that
    do, from the left: two numbers side by side may be proposed as one. A part begins and ends with a
    run of characters that no white space divides, and holds 19 digits at most."""
    if holds_value(kind, s):
        yield 0, len(s)
        return
    runs = [m.span() for m in re.finditer(r"\S+", s)]
    i = 0
    while i < len(runs):
        digits, good = 0, None
        for j in range(i, len(runs)):
            digits += sum(map(len, _NUMBER.findall(s[slice(*runs[j])])))
            if digits > 19 or j - i > 19:
                break
            if holds_value(kind, s[runs[i][0]:runs[j][1]]):
                good = j
        if good is not None:
            yield runs[i][0], runs[good][1]
        i = i + 1 if good is None else good + 1


def restyled(kind: int, s: str, rng: random.Random) -> str:
    """The same datum in another notation that the patterns may miss, for training."""
    digits = "".join(_NUMBER.findall(s))
    if kind == 0 and "@" in s:
        name, host = s.split("@", 1)
        return name + rng.choice(["@", " @ ", "(at)", " (at) ", "[at]", " [at] "]) + host.replace(".", rng.choice([".", ".", "[.]", "(dot)"]))
    if kind == 2:
        return rng.choice([" ", "-", ".", "/"]).join(digits[i:i + 4] for i in range(0, len(digits), 4))
    if kind == 3 and len(digits) > 8:
        a, b, c = digits[:-10], digits[-10:-7], digits[-7:]
        return rng.choice([f"+{a}.{b}.{c[:3]}.{c[3:]}", f"00{a} {b} {c[:3]} {c[3:]}", f"({b}) {c[:3]}-{c[3:]}",
                           f"+{a}/{b}/{c}", f"{b}-{c[:3]}-{c[3:]}"])
    return s


def training_windows(text: str, spans: list[tuple[int, int, int]], failed: list[tuple[int, int]], width: int
                     ) -> Iterator[tuple[int, str, bytes]]:
    """(stratum, window, its labels) around each span as it stands and in another notation,
    around marks that look alike, and at one more place of the text. Windows that show a
    match that fails its check are left out, since its label is not known, but for
    one inside a span or within a longer run of letters and digits."""
    rng = random.Random(int.from_bytes(hashlib.blake2b(text[:4096].encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big"))
    doubtful = [(a, b) for a, b in failed if not any(x <= a and b <= y for _, x, y in spans)
                and not text[a - 1:a].isalnum() and not text[b:b + 1].isalnum()]

    def window(stratum: int, centre: int, swap: tuple[int, int, int] | None = None) -> Iterator[tuple[int, str, bytes]]:
        a = max(0, min(centre - rng.randrange(8, width - 8), max(len(text) - width, 0)))
        b = min(a + width, len(text))
        if any(x < b and y > a for x, y in doubtful):
            return
        inside = [(k, s - a, e - a) for k, s, e in spans if s < b and e > a]
        if any(s < 0 or e > b - a for _, s, e in inside):
            return
        part = text[a:b]
        if swap:
            k, s, e = swap[0], swap[1] - a, swap[2] - a
            if s < 0 or e > len(part) or any((s, e) != (x, y) and x < e and y > s for _, x, y in inside):
                return
            new = restyled(k, part[s:e], rng)
            part, shift = part[:s] + new + part[e:], len(new) - (e - s)
            inside = [(k2, x, x + len(new)) if x == s else (k2, x + shift * (x >= e), y + shift * (x >= e)) for k2, x, y in inside]
        labels = tagger.label_array(len(part), inside)
        yield stratum, part[:width + 16], labels.tobytes()[:width + 16]

    for span in spans:
        yield from window(span[0], (span[1] + span[2]) // 2)
        yield from window(span[0], (span[1] + span[2]) // 2, span)
    covered = [(s, e) for _, s, e in spans]
    signs = [m.start() for m in re.finditer(r"[0-9@+=#]", text[:65536]) if not any(s <= m.start() < e for s, e in covered)]
    for centre in rng.sample(signs, min(2, len(signs))):
        yield from window(len(KINDS), centre)
    if text:
        yield from window(len(KINDS) + 1, rng.randrange(len(text)))


def fit(labelled: DataFrame, text_col: str = "text", spans_col: str | None = None, sampling: Sampling = Sampling(),
        settings: tagger.Settings = tagger.Settings()) -> tagger.Tagger | None:
    """Train the model on labelled spans: ``spans_col`` holds them as an array of (kind, start,
    end), or the spans that the patterns find are the labels. Texts enter once however
    often they recur, chosen by their hash, so that repeated rows and ids do not matter.
    Null texts or spans count as empty. None if no span is labelled."""
    spark = labelled.sparkSession
    small_batches(spark)
    named = {k: i for i, k in enumerate(KINDS)}
    text, given = F.coalesce(F.col(text_col), F.lit("")), F.col(spans_col) if spans_col else F.lit(None)
    rows = labelled.select(text.alias("t"), given.cast(SPANS).alias("s"), F.xxhash64(text, F.lit(13)).alias("h"))
    total = labelled.count()
    share = min(1.0, sampling.docs / max(total, 1))
    rows = rows.where(F.shiftrightunsigned("h", 1) <= F.lit(min(int(share * 2.0 ** 63), 2 ** 63 - 1)))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple[int, str, bytes]] = []
            for text, spans in zip(b.column("t").to_pylist(), b.column("s").to_pylist(), strict=True):
                found, failed = base_spans(text)
                if spans_col:
                    found = [(named[s["kind"]], s["start"], s["end"]) for s in spans or () if s and s["kind"] in named]
                out.extend(training_windows(text, found, failed, sampling.width))
            keys = [int.from_bytes(hashlib.blake2b(w.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big") >> 1 for _, w, _ in out]
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[0] for o in out], pa.int32()), pa.array(keys, pa.int64()), pa.array([o[1] for o in out], pa.string()),
                 pa.array([o[2] for o in out], pa.binary())], ["stratum", "key", "w", "labels"])

    windows = written(rows.mapInArrow(cut, "stratum int, key long, w string, labels binary").dropDuplicates(["stratum", "w"]), "pii")
    chosen = None
    for stratum in range(len(KINDS) + 2):
        part = windows.where(F.col("stratum") == stratum).orderBy("key", "w").limit(sampling.per_kind * (1 if stratum < len(KINDS) else 3))
        chosen = part if chosen is None else chosen.unionAll(part)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sample = sorted({(r["key"], r["w"], r["labels"]) for b in batches for r in b.to_pylist()})
        if not any(any(labels) for *_, labels in sample):
            return
        codes = np.full((len(sample), sampling.width + 16), tagger.CLASSES - 1, np.uint8)
        gold = np.zeros(codes.shape, np.int8)
        for i, (_, w, labels) in enumerate(sample):
            codes[i, :len(w)], gold[i, :len(w)] = tagger.char_classes(w), np.frombuffer(labels, np.int8)
        held = io.BytesIO()
        np.savez(held, **tagger.train(KINDS, codes, gold, settings).weights)
        yield pa.RecordBatch.from_arrays([pa.array([held.getvalue()], pa.binary())], ["weights"])

    # The bounded sample is learned from in one task, whose numpy has one thread.
    learned = chosen.select("key", "w", "labels").repartition(1).mapInArrow(learn, "weights binary").collect()
    if not learned:
        return None
    with np.load(io.BytesIO(learned[0].weights)) as weights:
        return tagger.Tagger(KINDS, settings, {k: weights[k] for k in weights.files})


def spans_of(texts: list[str], model: tagger.Tagger | None, everywhere: bool = False) -> list[tuple[list, list]]:
    """Base spans and added spans of each text. ``everywhere``: score also the windows that can add none."""
    base = [base_spans(t)[0] for t in texts]
    added: list[list] = [[] for _ in texts]
    if model:
        for i, spans in enumerate(tagger.tag(model, texts, None if everywhere else marks)):
            text, taken = texts[i], [(a, b) for _, a, b in base[i]]
            for kind, start, end in spans:
                if (kind, start, end) in base[i]:
                    continue
                for x, y in valued_parts(kind, text[start:end]):
                    a, b = start + x, start + y
                    if all(b <= u or a >= v for u, v in taken) and not text[a - 1:a].isalnum() and not text[b:b + 1].isalnum():
                        added[i].append((kind, a, b))
    return list(zip(base, added, strict=True))


def find(docs: DataFrame, model: tagger.Tagger | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``base`` and ``added``: spans of personal data in every whole text.

    Each is an array of (kind, start, end) by start, then kind as in ``KINDS``; places are code
    points, ends exclusive. ``base`` holds what the patterns find (leftmost,
    without overlap within a kind, failing matches dropped). ``added`` holds what the model
    sees beside them: spans that overlap no base span nor each other, hold a value of their
    kind and touch no letter or digit. Null and
    empty texts have none; without a model nothing is added. Repeated rows and null ids
    are rows like any other; an empty table gives an empty result. Other columns are not read.

    The model scores the windows that hold a digit, @ or a bracketed "at", and their neighbours: no
    span without one of these holds a value.
    """
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)       # fixed size: hidden units x character classes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = spans_of([t or "" for t in b.column("t").to_pylist()], shared.value)
            lists = [[[{"kind": KINDS[k], "start": a, "end": e} for k, a, e in side] for side in sides] for sides in zip(*found, strict=True)] or [[], []]
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(lists[0], kind), pa.array(lists[1], kind)], ["id", "base", "added"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
    kind = T._parse_datatype_string(SPANS)
    found = rows.mapInArrow(run, T.StructType([rows.schema["id"], T.StructField("base", kind), T.StructField("added", kind)]))
    return found.select(F.col("id").alias(id_col), "base", "added")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def joined(spans: Column) -> Column:
    """kind:start:end of spans, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def merged(base: Column, added: Column) -> Column:
    """Both lists as one, by start and kind."""
    place = F.array(*map(F.lit, KINDS))
    keyed = F.transform(F.concat(base, added), lambda s: F.struct(s["start"].alias("a"), F.array_position(place, s["kind"]).alias("k"), s.alias("s")))
    return F.transform(F.array_sort(keyed), lambda x: x["s"])
