"""Character-level bidirectional LSTM with a CRF on top, in numpy.

Cells and gates use x / (1 + |x|) (gates: half of it plus a half). Labels are O, and a first and an inner label for each kind of span. Training is Adam
on the CRF's negative log likelihood with its exact gradient through time. Scoring
runs many windows side by side, a character per step; windows are ordered by
length, so that none is padded.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np

CLASSES = 130       # ASCII, one class for all other characters, one for what is beyond a training window
NEVER = -1e4


@dataclass(frozen=True)
class Settings:
    """``hidden`` units a direction; ``epochs`` over the training windows in batches of
    ``batch``; scoring windows of ``window`` characters that overlap by ``overlap``."""

    hidden: int = 10
    epochs: int = 8
    batch: int = 128
    rate: float = 0.04
    window: int = 512
    overlap: int = 64
    seed: int = 13


@dataclass
class Tagger:
    """``weights``: for each direction ``in`` (4 hidden x classes), ``rec`` (4 hidden x
    hidden), ``out`` (labels x hidden); and ``bias``, ``start`` and ``move`` of the CRF."""

    kinds: tuple[str, ...]
    settings: Settings
    weights: dict[str, np.ndarray] = field(default_factory=dict)

    @property
    def labels(self) -> int:
        return 1 + 2 * len(self.kinds)


def char_classes(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.minimum(codes, 128).astype(np.uint8)


def label_array(n: int, spans: list[tuple[int, int, int]]) -> np.ndarray:
    """Labels of ``n`` characters from spans (kind number, start, end); of spans that overlap the longest counts."""
    labels = np.zeros(n, np.int8)
    for kind, a, b in sorted(spans, key=lambda s: (s[1] - s[2], s)):
        if not labels[a:b].any():
            labels[a:b] = 2 + 2 * kind
            labels[a] = 1 + 2 * kind
    return labels


def allowed(labels: int) -> tuple[np.ndarray, np.ndarray]:
    """0 where a label may start a window or follow another, else ``NEVER``: an inner label follows its own kind only."""
    move = np.zeros((labels, labels))
    start = np.zeros(labels)
    for inner in range(2, labels, 2):
        start[inner] = NEVER
        move[:, inner] = NEVER
        move[[inner - 1, inner], inner] = 0.0
    return start, move


def _soft(x: np.ndarray, out: np.ndarray) -> np.ndarray:
    """x / (1 + |x|): the cells' activation, a seventh of the time of tanh in numpy."""
    d = np.abs(x)
    d += 1
    return np.divide(x, d, out=out)


def _direction(table: np.ndarray, rec: np.ndarray, codes: np.ndarray) -> list[tuple]:
    """What each step of one direction over ``codes`` (steps x batch) computes."""
    hid = rec.shape[1]
    h = np.zeros((hid, codes.shape[1]))
    c = np.zeros_like(h)
    states = []
    for row in codes:
        z = table[:, row] + rec @ h
        _soft(z, z)
        gates = z[:3 * hid]
        gates *= 0.5
        gates += 0.5
        before, last = c, h
        c = gates[hid:2 * hid] * c + gates[:hid] * z[3 * hid:]
        t = _soft(c, np.empty_like(c))
        h = gates[2 * hid:] * t
        states.append((h, last, before, z, t))
    return states


def _direction_gradient(rec: np.ndarray, codes: np.ndarray, states: list[tuple], dh: np.ndarray):
    """Gradients of table and recurrent weights from those of the states (steps x hidden x batch)."""
    hid = rec.shape[1]
    dz = np.empty((len(codes), 4 * hid, codes.shape[1]))
    back_h = back_c = 0.0

    def slope(y: np.ndarray) -> np.ndarray:
        return (1 - np.abs(y)) ** 2

    for t in range(len(codes) - 1, -1, -1):
        _, _, before, z, soft_c = states[t]
        i, f, o, g = z[:hid], z[hid:2 * hid], z[2 * hid:3 * hid], z[3 * hid:]
        d = dh[t] + back_h
        dc = d * o * slope(soft_c) + back_c
        dz[t] = np.concatenate((dc * g, dc * before, d * soft_c, dc * i))
        y = np.concatenate((2 * z[:3 * hid] - 1, g))
        dz[t] *= slope(y)
        dz[t, :3 * hid] /= 2
        back_c = dc * f
        back_h = rec.T @ dz[t]
    flat = dz.transpose(1, 0, 2).reshape(4 * hid, -1)
    d_rec = flat @ np.array([s[1] for s in states]).transpose(1, 0, 2).reshape(hid, -1).T
    order = np.argsort(codes, axis=None, kind="stable")
    at = codes.ravel()[order]
    first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    d_table = np.zeros((4 * hid, CLASSES))
    d_table[:, at[first]] = np.add.reduceat(flat[:, order], first, axis=1)
    return d_table, d_rec


def crf_gradient(scores: np.ndarray, gold: np.ndarray, start: np.ndarray, move: np.ndarray):
    """Mean negative log likelihood of ``gold`` (steps x batch) under label scores
    (steps x labels x batch), and its gradients by scores, start and move."""
    steps, labels, batch = scores.shape
    top = scores.max(axis=1, keepdims=True)
    e = np.exp(scores - top)
    m = np.exp(move)
    alpha, scale = np.empty_like(e), np.empty((steps, batch))
    now = np.exp(start)[:, None] * e[0]
    for t in range(steps):
        if t:
            now = (m.T @ alpha[t - 1]) * e[t]
        scale[t] = now.sum(axis=0)
        alpha[t] = now / scale[t]
    beta = np.ones((labels, batch))
    d_scores, d_move = np.empty_like(e), np.zeros_like(move)
    for t in range(steps - 1, -1, -1):
        d_scores[t] = alpha[t] * beta
        if t:
            right = e[t] * beta / scale[t]
            d_move += m * (alpha[t - 1] @ right.T)
            beta = m @ right
    rows = np.arange(batch)
    gold_score = start[gold[0]].sum() + move[gold[:-1], gold[1:]].sum()
    for t in range(steps):
        gold_score += scores[t, gold[t], rows].sum()
        d_scores[t, gold[t], rows] -= 1.0
    np.add.at(d_move, (gold[:-1].ravel(), gold[1:].ravel()), -1.0)
    loss = float(np.log(scale).sum() + top.sum() - gold_score)
    d_start = d_scores[0].sum(axis=1)
    return loss / batch, d_scores / batch, d_start / batch, d_move / batch


def gradient(t: Tagger, codes: np.ndarray, gold: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Loss and gradients over windows of one length (steps x batch)."""
    w = t.weights
    fwd = _direction(w["in_f"], w["rec_f"], codes)
    bwd = _direction(w["in_b"], w["rec_b"], codes[::-1])
    hf = np.array([s[0] for s in fwd])
    hb = np.array([s[0] for s in bwd])[::-1]
    scores = w["out_f"] @ hf + w["out_b"] @ hb + w["bias"][:, None]
    mask = allowed(t.labels)
    loss, ds, d_start, d_move = crf_gradient(scores, gold, w["start"] + mask[0], w["move"] + mask[1])
    g = {"bias": ds.sum(axis=(0, 2)), "start": d_start * (mask[0] == 0), "move": d_move * (mask[1] == 0),
         "out_f": np.einsum("tlb,thb->lh", ds, hf, optimize=True), "out_b": np.einsum("tlb,thb->lh", ds, hb, optimize=True)}
    g["in_f"], g["rec_f"] = _direction_gradient(w["rec_f"], codes, fwd, w["out_f"].T @ ds)
    g["in_b"], g["rec_b"] = _direction_gradient(w["rec_b"], codes[::-1], bwd, (w["out_b"].T @ ds)[::-1])
    return loss, g


def train(kinds: tuple[str, ...], codes: np.ndarray, gold: np.ndarray, settings: Settings = Settings()) -> Tagger:
    """Fit on windows of one length (windows x steps); the same input gives the same weights."""
    rng = np.random.default_rng(settings.seed)
    hid, labels = settings.hidden, 1 + 2 * len(kinds)
    w: dict[str, np.ndarray] = {"bias": np.zeros(labels), "start": np.zeros(labels), "move": np.zeros((labels, labels))}
    for d in "fb":
        w[f"in_{d}"] = rng.normal(0, 0.3, (4 * hid, CLASSES))
        w[f"in_{d}"][hid:2 * hid] += 0.5        # forget little at first
        w[f"rec_{d}"] = rng.normal(0, 0.5 / hid ** 0.5, (4 * hid, hid))
        w[f"out_{d}"] = rng.normal(0, 0.3, (labels, hid))
    t = Tagger(kinds, settings, w)
    mean = {k: np.zeros_like(v) for k, v in w.items()}
    square = {k: np.zeros_like(v) for k, v in w.items()}
    step, total = 0, settings.epochs * -(-len(codes) // settings.batch)
    codes, gold = codes.astype(np.int64), gold.astype(np.int64)
    for _ in range(settings.epochs):
        order = rng.permutation(len(codes))
        for a in range(0, len(order), settings.batch):
            pick = order[a:a + settings.batch]
            _, g = gradient(t, codes[pick].T, gold[pick].T)
            norm = sum(float((x * x).sum()) for x in g.values()) ** 0.5
            shrink = min(1.0, 5.0 / max(norm, 1e-12))
            step += 1
            rate = settings.rate * (1 - 0.9 * step / total)
            for k in w:
                x = g[k] * shrink
                mean[k] += 0.1 * (x - mean[k])
                square[k] += 0.01 * (x * x - square[k])
                w[k] -= rate * (mean[k] / (1 - 0.9 ** step)) / (np.sqrt(square[k] / (1 - 0.99 ** step)) + 1e-8)
    mask = allowed(labels)
    w["start"], w["move"] = w["start"] + mask[0], w["move"] + mask[1]
    t.weights = {k: v.astype(np.float32) for k, v in w.items()}
    return t


def _scores_of(t: Tagger, table: str, rec: str, out: str, codes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Label scores of one direction (steps x labels x windows); windows by falling length."""
    w = t.weights
    hid = t.settings.hidden
    table, joint = w[table], np.concatenate((w[rec], w[out]))     # one product a step serves both
    scores = np.zeros((len(codes), t.labels, codes.shape[1]), np.float32)
    active = codes.shape[1]
    h = np.zeros((hid, active), np.float32)
    c = np.zeros_like(h)
    for step, row in enumerate(codes):
        both = joint @ h
        if step:
            scores[step - 1, :, :active] = both[4 * hid:]
        now = int(np.searchsorted(-lengths, -step, side="left"))
        if now < active:
            active = now
            both, c = both[:, :now], np.ascontiguousarray(c[:, :now])
            h = np.empty_like(c)
        z = np.take(table, row[:active], axis=1, mode="clip")
        z += both[:4 * hid]
        _soft(z, z)
        gates = z[:3 * hid]
        gates *= 0.5
        gates += 0.5
        c *= gates[hid:2 * hid]
        g = z[3 * hid:]
        g *= gates[:hid]
        c += g
        _soft(c, h)
        h *= gates[2 * hid:]
    scores[-1, :, :active] = (joint @ h)[4 * hid:]
    return scores


def label_scores(t: Tagger, windows: list[np.ndarray]) -> np.ndarray:
    """Scores (steps x labels x windows) of windows given by falling length."""
    lengths = np.array([len(x) for x in windows])
    rows = np.zeros((2, len(windows), lengths[0]), np.uint8)
    for i, x in enumerate(windows):
        rows[0, i, :len(x)] = x
        rows[1, i, :len(x)] = x[::-1]
    there, back = (r.T.astype(np.intp) for r in rows)
    scores = _scores_of(t, "in_f", "rec_f", "out_f", there, lengths)
    turned = _scores_of(t, "in_b", "rec_b", "out_b", back, lengths)
    steps = np.arange(lengths[0])
    at = lengths - 1 - steps[:, None]
    for i in np.unique(lengths):
        same = slice(*np.searchsorted(-lengths, [-i, -i + 1]))
        scores[:i, :, same] += turned[:i, :, same][::-1]
    scores += t.weights["bias"][:, None]
    scores.transpose(0, 2, 1)[at < 0] = [0.0] + [NEVER] * (t.labels - 1)     # beyond a window's end
    return scores


def suspects(t: Tagger, scores: np.ndarray) -> np.ndarray:
    """Windows whose best path may hold a span. For the others the path without one is
    best: no label's lead over O, with the most that moves into and out of it
    can add, is positive anywhere."""
    move = t.weights["move"]
    into = (move[:, 1:].max() - move[0, 0])
    out = max(0.0, float((move[1:, 0] - move[0, 0]).max()))
    begin = max(0.0, float((t.weights["start"][1:] - t.weights["start"][0]).max() - into))
    lead = scores[:, 1:].max(axis=1) - scores[:, 0]
    lead[0] += begin
    return np.flatnonzero((lead + into + out > 0).any(axis=0))


def best_paths(t: Tagger, scores: np.ndarray, lengths: np.ndarray) -> list[np.ndarray]:
    """Viterbi paths of windows (steps x labels x windows)."""
    start, move = t.weights["start"], t.weights["move"]
    steps, labels, n = scores.shape
    best = start[:, None] + scores[0]
    came = np.zeros((steps, labels, n), np.int8)
    ends = np.where(lengths == 1, best.argmax(axis=0), 0)
    for s in range(1, steps):
        through = best[:, None] + move[:, :, None]
        came[s] = through.argmax(axis=0)
        best = through.max(axis=0) + scores[s]
        ends = np.where(lengths == s + 1, best.argmax(axis=0), ends)
    paths = []
    for i in range(n):
        label, path = int(ends[i]), np.empty(lengths[i], np.int8)
        for s in range(lengths[i] - 1, -1, -1):
            path[s] = label
            label = came[s, label, i]
        paths.append(path)
    return paths


def spans_in(path: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(kind number, start, end) along a path."""
    for a in np.flatnonzero(path % 2 == 1):
        b = a + 1
        while b < len(path) and path[b] == path[a] + 1:
            b += 1
        yield (int(path[a]) - 1) // 2, int(a), int(b)


def window_starts(n: int, window: int, overlap: int) -> list[int]:
    """Starts of overlapping windows that cover ``n`` characters; the last may be shorter than ``window``."""
    return list(range(0, max(n - overlap, min(n, 1)), window - overlap))


def reconcile(found: list[tuple[int, int, int, int, bool, bool]]) -> list[tuple[int, int, int]]:
    """One set of spans from all windows of a text. ``found``: (kind, start, end, margin,
    cut left, cut right), where margin is the distance to the nearest window edge inside
    the text and a span is cut where it touches one. Spans of one kind that overlap or
    touch are joined if an edge cut one of them; of those that still overlap, the
    one with the larger margin stays (ties: the longer, the earlier, the first kind)."""
    joined: list[list] = []
    for kind, a, b, margin, left, right in sorted(set(found), key=lambda s: (s[0], s[1], s[2])):
        last = joined[-1] if joined else None
        if last and last[0] == kind and a <= last[2] and (last[5] or left) and (a, b) != (last[1], last[2]):
            last[1], last[2], last[3] = min(a, last[1]), max(b, last[2]), max(margin, last[3])
            last[5] = right if b >= last[2] else last[5]
        elif last and last[:3] == [kind, a, b]:
            last[3] = max(margin, last[3])
        else:
            joined.append([kind, a, b, margin, left, right])
    taken: list[tuple[int, int, int]] = []
    for kind, a, b, *_ in sorted(joined, key=lambda s: (-s[3], s[1] - s[2], s[1], s[0])):
        if all(b <= x or a >= y for _, x, y in taken):
            taken.append((kind, a, b))
    return sorted(taken, key=lambda s: (s[1], s[0]))


def tag(t: Tagger, texts: list[str], marks: Callable[[str], np.ndarray] | None = None, together: int = 512
        ) -> list[list[tuple[int, int, int]]]:
    """Spans (kind number, start, end) that the model sees in each whole text. ``marks`` gives the
    places in a text of which a span must hold one to be of use: windows that hold none,
    and have no neighbour that does, are not scored."""
    window, overlap = t.settings.window, t.settings.overlap
    found: list[list] = [[] for _ in texts]
    codes: dict[int, np.ndarray] = {}
    places = []
    for i, text in enumerate(texts):
        starts = np.array(window_starts(len(text), window, overlap), np.int64)
        if marks and len(starts):
            at = marks(text)
            held = np.searchsorted(at, starts + window) > np.searchsorted(at, starts)
            held[1:] |= (own := held.copy())[:-1]
            held[:-1] |= own[1:]
            starts = starts[held]
        if len(starts):
            codes[i] = char_classes(text)
            places.extend((i, int(a)) for a in starts)
    places.sort(key=lambda p: (-min(window, len(codes[p[0]]) - p[1]), p))
    for lo in range(0, len(places), together):
        group = places[lo:lo + together]
        windows = [codes[i][a:a + window] for i, a in group]
        scores = label_scores(t, windows)
        some = suspects(t, scores)
        if not len(some):
            continue
        lengths = np.array([len(windows[k]) for k in some])
        for k, path in zip(some, best_paths(t, np.ascontiguousarray(scores[:, :, some]), lengths), strict=True):
            i, at = group[k]
            inner_left, inner_right = at > 0, at + len(path) < len(codes[i])
            for kind, a, b in spans_in(path):
                margin = min(a if inner_left else window, len(path) - b if inner_right else window)
                found[i].append((kind, at + a, at + b, margin, inner_left and a == 0, inner_right and b == len(path)))
    return [reconcile(f) for f in found]
