"""Encoding of many texts by one byte-level vocabulary, each distinct unit once.

A unit is white space with the Latin letters after it, up to where letters end, or
else with all that follows up to the next white space. The splitting pattern of
byte-level vocabularies always ends a token in these places (added tokens must
start with something else than a letter and hold no white space), so the ids of a
text are those of its units in a row. Units recur; a worker encodes most of them once.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from itertools import chain

import numpy as np

from abx.llm.runtime import slices

# Latin letters up to where letters end, or else a run up to the next white space.
UNIT = re.compile(r"\s*[A-Za-zÀ-ÖØ-öø-ɏ]+(?![^\W\d_])|\s*\S+|\s+")
ODD = re.compile("[\x1c-\x1f]")     # white space to Python, not to the pattern: such texts are encoded whole
BLOCK = 1 << 22                     # characters looked up at once
CACHE_UNITS = 400_000               # in each of two generations per worker; results do not depend on it
JOINED_UNITS = 4096                 # encoded in one call


def library_units(tokenizer) -> Callable[[list[str]], list[bytes]]:
    """Ids (uint32 as bytes) of texts that the tokenizers library encodes each by itself.

    Many short texts are joined by a special token, which the library cuts out before
    anything else, so that it ends one text's ids and begins the next one's.
    """
    mark = next(((i, t.content) for i, t in tokenizer.get_added_tokens_decoder().items()
                 if t.special and not (t.normalized or t.lstrip or t.rstrip or t.single_word)), None)

    def encode(texts: list[str]) -> list[bytes]:
        if mark is None or len(texts) < 2 or any(mark[1] in t for t in texts):
            return [np.array(e.ids, "<u4").tobytes() for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        out: list[bytes] = []
        for a in range(0, len(texts), JOINED_UNITS):
            joined = mark[1].join(texts[a:a + JOINED_UNITS])
            ids = np.array(tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, "<u4")
            cut = 4 * np.flatnonzero(ids == mark[0])
            data = ids.tobytes()
            out += [data[x:y] for x, y in zip([0, *(cut + 4).tolist()], [*cut.tolist(), len(data)])]
        return out

    return encode


def known_units(units: list[list[str]], encode: Callable[[list[str]], list], cache: dict[str, dict]) -> dict:
    """What ``encode`` gives for each unit in ``units``; those that ``cache`` has are not encoded again."""
    need = set(chain.from_iterable(units))
    known = cache.setdefault("new", {})
    if len(known) > CACHE_UNITS:
        cache["old"], cache["new"] = known, {}
        known = cache["new"]
    old = cache.get("old", {})
    # Tested one by one: a set less a dict's keys would go through all keys of the dict.
    new = [u for u in need if u not in known]
    known.update((u, old[u]) for u in new if u in old)
    fresh = [u for u in new if u not in known]
    known.update(zip(fresh, encode(fresh)))
    return known


def encode_all(texts: list[str], encode: Callable[[list[str]], list[bytes]], cache: dict[str, dict]) -> list[bytes]:
    """What ``encode`` gives for each unit, joined per text (int32 ids as bytes, say). ``cache``
    keeps the units of the last two generations."""
    out: list[bytes] = []
    for a, b in slices(texts, BLOCK):
        units = [[] if ODD.search(t) else UNIT.findall(t) for t in texts[a:b]]
        known = known_units(units, encode, cache)
        out += [b"".join(map(known.__getitem__, u)) if u or not t else encode([t])[0]
                for u, t in zip(units, texts[a:b])]
    return out
