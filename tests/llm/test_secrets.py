"""The randomness battery: recall by encoding and length, false discoveries on
words, p-values and the bound of the false-discovery rate."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from studylake.llm import secrets

LOW, DIGITS = "abcdefghijklmnopqrstuvwxyz", "0123456789"
ALPHABETS = {"HEX": DIGITS + "ABCDEF", "base32": LOW.upper() + "234567", "digits and letters": LOW + DIGITS,
             "one case": LOW + DIGITS + "-_", "mixed": LOW + LOW.upper(), "alnum": LOW + LOW.upper() + DIGITS,
             "base64": LOW + LOW.upper() + DIGITS + "+/", "letters": LOW, "LETTERS": LOW.upper()}
WORDS = ("the of and in that it is for with was table column value reader writer partition shuffle broadcast window "
         "stream record example language computer science history people government water between through important "
         "children country another question number mountain morning quickly because together yellow kitchen").split()


def word_run(rng, style, n):
    out = ""
    while len(out) < n:
        w = rng.choice(WORDS)
        out += {"joined": w, "camel": w.title(), "slug": w + rng.choice("-_/"), "const": w.upper() + "_",
                "dated": w + rng.choice(["", "-"]) + (str(rng.randrange(2030)) if rng.random() < 0.1 else "")}[style]
    return out[:n]


def test_recall_by_encoding_and_false_discoveries(spark):
    rng = random.Random(3)
    rows, of = [], {}

    def add(key, run):
        of[len(rows)] = key
        rows.append((len(rows), f"see {run} there"))

    for name, symbols in ALPHABETS.items():
        for n in (24, 32, 40, 64):
            for _ in range(60):
                add((name, n), "".join(rng.choice(symbols) for _ in range(n)))
    for style in ("joined", "camel", "slug", "const", "dated"):
        for n in (20, 32, 64):
            for _ in range(150):
                add("words", word_run(rng, style, n))
    for k in range(200):
        add("digits", "".join(rng.choice(DIGITS) for _ in range(20 + k % 30)))
        add("rulers", rng.choice("=-_/") * (20 + k % 50))
    out = secrets.report(spark.createDataFrame(rows, "doc_id long, text string").repartition(8))
    hits = Counter(of[r["doc_id"]] for r in out.filter(F.col("spans").contains("random")).collect())
    for name in ALPHABETS:
        least = {24: 18, 32: 36, 40: 48, 64: 54} if name.lower() == "letters" else {24: 40, 32: 54, 40: 56, 64: 58}
        assert all(hits[name, n] >= least[n] for n in least), (name, hits)
    assert hits["digits"] == hits["rulers"] == 0
    assert hits["words"] <= 0.01 * sum(hits.values())


def test_tail_is_the_normal_one(spark):
    z = [1.0, -0.5, -1.0, -2.37, -4.0, -6.0, -8.0]
    got = spark.createDataFrame([(x,) for x in z], "z double").select("z", secrets._tail(F.col("z")).alias("p")).collect()
    for r in got:
        assert r["p"] == pytest.approx(-math.log10(0.5 * math.erfc(max(-r["z"], 0) / 2**0.5)), abs=0.02)


def test_bound_of_the_false_discovery_rate(spark):
    rng = random.Random(4)
    cells = [(c, min(399, int((rng.expovariate(0.6) if i % 3 else 0.05 * rng.random()) / secrets.STEP)))
             for i in range(1500) for c in (0, 1) if c == 0 or i < 40]
    rows = spark.createDataFrame([([{"cell": cell, "class": c}],) for c, cell in cells], "runs array<struct<cell:int,class:int>>")
    got = secrets.thresholds(rows)
    for c in (0, 1):
        p = sorted(10 ** -(cell * secrets.STEP) for k, cell in cells if k == c)
        found = [x for i, x in enumerate(p, 1) if x < 1 and x <= secrets.FDR * i / len(p)]
        assert (c in got) == bool(found)
        if found:
            assert 10 ** -(got[c] * secrets.STEP) == pytest.approx(max(found))
