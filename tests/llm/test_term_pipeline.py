"""Ranked search against a plain version that scores every pair."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest

from studylake.llm import term_pipeline as tp

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def plain(items, docs, top=10):
    counts = [(d, Counter(terms(t))) for d, t in docs]
    held = [(d, c) for d, c in counts if c]
    n_all, l_all = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scores = []
        for d, c in held:
            m = 100 - 90 + (90 * sum(c.values()) * n_all) // l_all
            s = sum(math.floor(1000 * math.log((2 * n_all + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                    for t in set(terms(text)) if c[t])
            if s > 0:
                scores.append((-s, d is None, d or 0, d))
        out += [(item, r, s[3], -s[0]) for r, s in enumerate(sorted(scores)[:top], 1)]
    return out


def check(spark, items, docs):
    i = spark.createDataFrame([(*r, 1) for r in items], "item_id long, text string, rank int")
    d = spark.createDataFrame([(*r, 1, "x") for r in docs], "doc_id long, text string, score long, item_id string").repartition(3)
    got = sorted((str(r["item_id"]), r["rank"], str(r["doc_id"]), r["score"]) for r in tp.rank(i, d).collect())
    assert got == sorted((str(a), b, str(c), s) for a, b, c, s in plain(items, docs))
    return got


@pytest.mark.parametrize("block", [7, 50, 4096])
def test_equals_plain_version(spark, monkeypatch, block):
    monkeypatch.setattr(tp, "BLOCK_DOCS", block)
    monkeypatch.setattr(tp, "BUNDLE_ITEMS", 3)
    rng = random.Random(block)
    vocabulary = [f"w{i}" for i in range(60)] + ["Ünï", "ÉCLAIR", "日本語", "x2"]
    def text(n):
        return " ".join(rng.choices(vocabulary, [1 / (i + 1) for i in range(len(vocabulary))], k=n))
    docs = [(i, text(rng.randint(0, 60))) for i in range(200)]
    check(spark, [(i, text(rng.randint(0, 12))) for i in range(25)], docs)


def test_awkward_rows(spark):
    long = " ".join(f"word{i % 997}" for i in range(300_000)) + " needle"
    docs = [(1, "The needle, the NEEDLE!"), (2, None), (3, ""), (4, " \t--"), (5, long), (6, "needle"), (6, "needle"),
            (None, "needle"), (7, "a" * (3 << 20)), (8, "nul\0needle_x"), (9, "İstanbul needle"), (None, None)]
    items = [(1, "needle"), (1, "needle"), (2, None), (3, "..."), (4, "absent"), (None, "the needle word5 " + "a" * (3 << 20)), (5, "istanbul İstanbul")]
    got = check(spark, items, docs)
    assert {r[0] for r in got} == {"1", "None", "5"}


def test_pieces_equal_whole_text(monkeypatch):
    text = "Aa bb-CC " * 50 + "d" * 40 + " é1 " * 9
    whole = tp.term_counts(text)
    monkeypatch.setattr(tp, "PIECE", 16)
    assert tp.term_counts(text) == whole == Counter(t.encode() for t in terms(text))


def test_rounds_and_empty_tables(spark, monkeypatch):
    docs = [(i, f"a b{i % 5} c{i % 7}") for i in range(40)]
    items = [(i, f"b{i % 5} c{i}") for i in range(9)]
    monkeypatch.setattr(tp, "ROUND_BYTES", 20)
    check(spark, items, docs)
    check(spark, items, [])
    check(spark, [], docs)
