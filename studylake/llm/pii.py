"""Personal data: fixed patterns plus a character-level BiLSTM-CRF.

Patterns give the base spans (e-mail, IP address, payment card, phone). They
label a bounded sample of windows, together with windows made from templates,
and a bidirectional LSTM with CRF transitions is trained on both. In every whole
text, overlapping windows are scored wherever a window holds a digit or an @
(each of the four kinds must hold one, so a window without either has no span);
the scores of overlapping windows are averaged, weighted towards each window's
middle, and each stretch of joined windows is decoded as one sequence, so a
span may cross windows. A long stretch is decoded in segments of 2,048
characters with 256 more on either side, and a span counts where its start is
in the segment's own part; so all arrays are bounded, whatever the text's
length, and the whole text is decoded (an added span of more than 256 characters
could be cut at a segment's end). Decoded spans that no base span touches, that
the model is sure of and that obey their kind's arithmetic are added; base spans
stay.

Nulls and odd rows: a null text counts as empty and has no spans; a null doc_id
is carried through; each input row gives one output row, repeated rows
included; other columns are ignored, whatever their names; an empty table gives
an empty result.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from studylake.llm import lstm_crf as N
from studylake.llm.common import first_by, text_of

KINDS = ("email", "ip", "card", "phone")
#: Labels: outside, then beginning and inside of each kind.
N_LABELS = 1 + 2 * len(KINDS)
WINDOW, STEP = 48, 32
#: Bounds of the training sample: documents, and windows of a document.
MAX_DOCS, MAX_WINDOWS, MADE = 600, 6, 250
EPOCHS, SEED = 10, 11
#: Least probability of every label of an added span.
SURE = 0.8
#: Windows scored at once; characters decoded at once.
BATCH, DECODED = 1024, 1 << 16
#: Windows of a segment's own part, and further ones on either side.
OWN, BESIDE = 64, 8

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TRIGGER = re.compile(r"[0-9@]")

Span = tuple[int, int, int]  # start, kind, stop


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _octets(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in text.split("."))


def obeys(kind: int, text: str) -> bool:
    """The arithmetic of each kind."""
    n = len(_digits(text))
    if kind == 0:
        local, at, domain = text.partition("@")
        return bool(at and local.strip() and "." in domain.strip("."))
    if kind == 1:
        return re.fullmatch(r"[0-9]+(\.[0-9]+){3}", text) is not None and _octets(text)
    if kind == 2:
        return 12 <= n <= 19 and _luhn(_digits(text))
    return 9 <= n <= 15


def base_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping matches of each kind, failing ones dropped.

    Each search is linear in the text: an e-mail is looked for around its @,
    and no pattern starts again inside a run that has failed."""
    out: list[Span] = []
    at, end = text.find("@"), 0
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            end = m.end()
            out.append((start, 0, end))
        at = text.find("@", max(at + 1, end))
    if _TRIGGER.search(text):
        out += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if _octets(m[0])]
        out += [(m.start(), 2, m.end()) for m in _CARD.finditer(text) if obeys(2, m[0])]
        if "+" in text:
            out += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if obeys(3, m[0])]
    return sorted(out)


def label(n: int, spans: list[Span]) -> np.ndarray:
    """Labels of n characters; of overlapping spans the first and longest counts."""
    y, end = np.zeros(n, np.int64), 0
    for a, k, b in sorted(spans, key=lambda s: (s[0], -s[2], s[1])):
        if a >= end:
            y[a], y[a + 1:b], end = 1 + 2 * k, 2 + 2 * k, b
    return y


def window_starts(text: str) -> np.ndarray:
    """Starts of the windows that hold a digit or an @; windows tile the whole text."""
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    unit = np.gcd(WINDOW, STEP)
    held = np.zeros((-(-len(code) // unit) + WINDOW // unit, unit), bool)
    held.reshape(-1)[:len(code)] = ((code >= 48) & (code <= 57)) | (code == 64)
    held = held.any(1)
    n = -(-len(code) // STEP)
    reach = np.zeros(n, bool)
    for k in range(WINDOW // unit):
        reach |= held[k:k + n * (STEP // unit):STEP // unit][:n]
    return np.flatnonzero(reach) * STEP


def _window(codes: np.ndarray, start: int) -> np.ndarray:
    part = codes[start:start + WINDOW]
    return part if len(part) == WINDOW else np.concatenate([part, np.full(WINDOW - len(part), N.PAD)])


def _made(rng: np.random.Generator) -> tuple[str, list[Span]]:
    """A labelled text from templates, among made-up words."""
    word = lambda: "".join(rng.choice(list("aeioulnrstdmcph"), rng.integers(2, 9)))
    num = lambda n: "".join(rng.choice(list("0123456789"), n))
    kind = int(rng.integers(-2, 4))
    if kind == 0:
        value = f"{word()}{rng.choice(['.', '_', '-', ''])}{rng.choice([word(), num(2)])}@{word()}{rng.choice(['', num(1)])}.{rng.choice(['com', 'org', 'example.com', 'net', 'co.uk'])}"
    elif kind == 1:
        value = ".".join(str(rng.integers(0, 256)) for _ in range(4))
    elif kind == 2:
        body = num(15)
        value = next(body + str(d) for d in range(10) if _luhn(body + str(d)))
        if rng.random() < 0.4:
            value = rng.choice([" ", "-"]).join(value[i:i + 4] for i in range(0, 16, 4))
    elif kind == 3:
        sep = rng.choice([" ", "-", "."])
        value = rng.choice([f"+{rng.integers(1, 99)} ({num(3)}) {num(3)}-{num(4)}", f"+{rng.integers(1, 99)}{sep}{num(3)}{sep}{num(3)}{sep}{num(4)}",
                            f"({num(3)}) {num(3)}-{num(4)}", f"{num(3)}-{num(3)}-{num(4)}"])
    else:  # numbers that are not personal
        value = rng.choice([f"{rng.integers(1, 9)}.{rng.integers(0, 9)}", num(int(rng.integers(1, 7))), f"{rng.integers(1900, 2030)}-0{rng.integers(1, 9)}-{rng.integers(10, 28)}",
                            f"{num(3)},{num(3)}", f"AKIA{num(4)}{word().upper()}", f"{num(3)}{word()}{num(5)}{word()}{num(6)}", f"v{num(1)}.{num(1)}.{num(2)}", f"@{word()}", f"{num(2)}%"])
    before = " ".join(word() for _ in range(rng.integers(0, 5))) + " "
    text = before + value + rng.choice([" ", ". ", ", ", "\n"]) + " ".join(word() for _ in range(rng.integers(0, 5)))
    return text, [(len(before), kind, len(before) + len(value))] if kind >= 0 else []


def training_windows(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Windows and labels from a bounded list of texts and from templates."""
    rng = np.random.default_rng(SEED)
    xs, ys = [], []
    pad = np.zeros(WINDOW, np.int64)
    examples = [(t, base_spans(t)) for t in texts] + [_made(rng) for _ in range(4 * MADE)]
    for text, spans in examples:
        codes, y = N.encode(text), np.concatenate([label(len(text), spans), pad])
        starts = window_starts(text)
        if len(starts) > MAX_WINDOWS:
            starts = rng.choice(starts, MAX_WINDOWS, replace=False)
        for s in starts:
            s = int(max(0, s - rng.integers(0, STEP)))
            xs.append(_window(codes, s))
            ys.append(y[s:s + WINDOW])
    return np.stack(xs), np.stack(ys)


def fit(docs: DataFrame) -> N.Params:
    """Train on excerpts around the first digit or @ of at most MAX_DOCS texts
    that hold one, the first by a seeded hash."""
    trigger = docs.select("doc_id", text_of("text").alias("text")).filter(F.col("text").rlike("[0-9@]"))
    order = F.xxhash64(F.lit(SEED), "doc_id", "text")
    ids = trigger.select(order.alias("o"), F.regexp_extract("text", r"(?s)(.{0,120}[0-9@].{0,160})", 1).alias("part"))
    rows = first_by(ids, "o", MAX_DOCS, "part").collect()
    x, y = training_windows([r["part"] for r in rows])
    p = N.train(x, y, N_LABELS, EPOCHS)
    return {k: v.astype(np.float32) for k, v in p.items()}


Segment = tuple[np.ndarray, int, int, int, int]  # window starts, first and end character, own part's


def _segments(starts: np.ndarray, n: int) -> list[Segment]:
    """Runs of windows that overlap, long ones in pieces."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > WINDOW - 1) + 1
    edges = np.concatenate([[0], cut, [len(starts)]])
    out = []
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        first, end = int(starts[a]), int(min(n, starts[b - 1] + WINDOW))
        if b - a <= OWN + 2 * BESIDE:
            out.append((starts[a:b], first, end, first, end))
            continue
        for c in range(a, b, OWN):
            own = starts[max(a, c - BESIDE):min(b, c + OWN + BESIDE)]
            out.append((own, int(own[0]), int(min(n, own[-1] + WINDOW)), int(starts[c]),
                        int(starts[c + OWN]) if c + OWN < b else end))
    return out


_MIDDLE = (1.0 + np.minimum(np.arange(WINDOW), np.arange(WINDOW)[::-1])).astype(np.float32)


def decode(p: N.Params, texts: list[str]) -> list[list[Span]]:
    """Model spans of each whole text."""
    out: list[list[Span]] = [[] for _ in texts]
    waiting: list[tuple[int, Segment]] = []
    jobs: list[tuple[int, Segment, np.ndarray]] = []  # text, segment, merged scores
    n_waiting = n_scored = 0

    def score() -> None:
        nonlocal n_waiting, n_scored
        if waiting:
            parts = [(N.encode(texts[i][first:end]), starts - first) for i, (starts, first, end, _, _) in waiting]
            x = np.stack([_window(codes, int(o)) for codes, at in parts for o in at])
            e = np.concatenate([N.emissions(p, x[a:a + BATCH]) for a in range(0, len(x), BATCH)])
            k = 0
            for (i, seg), (codes, at) in zip(waiting, parts, strict=True):
                total = np.zeros((len(codes) + WINDOW, N_LABELS), np.float32)
                weight = np.zeros(len(codes) + WINDOW, np.float32)
                for o in at.tolist():
                    total[o:o + WINDOW] += e[k] * _MIDDLE[:, None]
                    weight[o:o + WINDOW] += _MIDDLE
                    k += 1
                jobs.append((i, seg, total[:len(codes)] / weight[:len(codes), None]))
                n_scored += len(codes)
        waiting.clear()
        n_waiting = 0

    def settle() -> None:
        nonlocal n_scored
        jobs.sort(key=lambda j: len(j[2]))
        at = 0
        while at < len(jobs):
            end = at
            while end < len(jobs) and (end == at or (end - at + 1) * len(jobs[end][2]) <= DECODED):
                end += 1
            group = jobs[at:end]
            e = np.zeros((len(group), len(group[-1][2]), N_LABELS), np.float32)
            e[:, :, 0] = 20.0  # behind its end a stretch is outside
            for r, (_, _, s) in enumerate(group):
                e[r, :len(s)] = s
            path = N.viterbi(e, p["move"])
            hit = np.flatnonzero(path.any(1))
            prob = N.posteriors(e[hit], p["move"]) if len(hit) else None
            for k, r in enumerate(hit):
                i, (_, first, _, own, own_end), s = group[r]
                out[i] += [f for f in _read(path[r, :len(s)], prob[k], first, texts[i]) if own <= f[0] < own_end]
            at = end
        jobs.clear()
        n_scored = 0

    for i, text in enumerate(texts):
        for seg in _segments(window_starts(text), len(text)):
            waiting.append((i, seg))
            n_waiting += len(seg[0])
            if n_waiting >= BATCH:
                score()
                if n_scored >= 4 * DECODED:
                    settle()
    score()
    settle()
    return [sorted(spans) for spans in out]


def _read(path: np.ndarray, prob: np.ndarray, first: int, text: str) -> list[Span]:
    """Spans of a path that the model is sure of and that obey their kind."""
    found, t = [], 0
    while t < len(path):
        if path[t] and path[t] % 2:
            kind, end = (int(path[t]) - 1) // 2, t + 1
            while end < len(path) and path[end] == 2 + 2 * kind:
                end += 1
            sure = prob[np.arange(t, end), path[t:end]].min() >= SURE
            if sure and obeys(kind, text[first + t:first + end]):
                found.append((first + t, kind, first + end))
            t = end
        else:
            t += 1
    return found


def spans(p: N.Params, texts: list[str]) -> list[tuple[list[Span], list[Span]]]:
    """Base spans and added spans of each text."""
    out = []
    for text, model in zip(texts, decode(p, texts), strict=True):
        base = base_spans(text)
        starts, reach = [b[0] for b in base], list(accumulate((b[2] for b in base), max))

        def free(s: Span) -> bool:
            before = bisect_left(starts, s[2])  # base spans that start before its end
            return not before or reach[before - 1] <= s[0]

        out.append((base, [s for s in model if free(s)]))
    return out


def _joined(found: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(found))


_RESULT = "n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string"


def report(docs: DataFrame) -> DataFrame:
    """Counts, digest and span lists of each document."""
    p = fit(docs)

    @F.pandas_udf(_RESULT)
    def scan(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for base, more in spans(p, texts.fillna("").tolist()):
            n = [0] * len(KINDS)
            for _, k, _ in base:
                n[k] += 1
            rows.append((*n, hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(base + more)))
        return pd.DataFrame(rows, columns=["n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"])

    return docs.select("doc_id", scan("text").alias("s")).select("doc_id", "s.*")
