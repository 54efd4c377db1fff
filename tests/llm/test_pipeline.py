"""The pipeline as a whole against a plain version of its stages; what is fitted
or drawn by hash (verdicts, secrets, the mix's choice) is taken from the operators."""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from studylake.llm import mixing, packing, quality_rules, secrets, tokens

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text))
    return frozenset(zip(*[w[k:] for k in range(5)])) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def leaders(texts):
    """Ids that are the smallest of their component of near copies."""
    sets, low = {i: shingles(t) for i, t in texts.items()}, {i: i for i in texts}
    ids = sorted(i for i in sets if sets[i])
    pairs = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1:]
             if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    for _ in ids:
        old = dict(low)
        for a, b in pairs:
            low[a] = low[b] = min(low[a], low[b])
        if old == low:
            break
    return {i for i in texts if low[i] == i}


def test_run_equals_its_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    good = {r["doc_id"] for r in quality_rules.judge(docs).filter("kept").collect()}
    left = leaders({i: texts[i] for i in good})
    assert len(left) < len(good) < len(texts)
    clean = secrets.clean(docs.filter(F.col("doc_id").isin(sorted(left)))).cache()
    masked = {r["doc_id"]: r["text"] or "" for r in clean.collect()}
    assert set(masked) == left
    copies = {}
    for r in mixing.mix(clean).collect():
        assert r["size"] == len(WORD.findall(masked[r["doc_id"]]))
        copies[r["doc_id"]] = r["taken"] // r["size"] if r["size"] else 0
    encoder, places, pieces = tokens.Encoder(tokens.default_path()), defaultdict(list), defaultdict(Counter)
    for r in corpus_pipeline.run(spark, SF).collect():
        pieces[r["doc_id"]][(r["piece"], r["start"], r["length"], r["ids_crc32"])] += 1
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(pieces) == {i for i, n in copies.items() if n}
    for i, found in pieces.items():
        ids, at = encoder.batch([masked[i]])[0] + b"\0\0\0\0", 0
        for (_, start, length, crc), n in sorted(found.items()):
            assert (start, n) == (at, copies[i]) and crc == zlib.crc32(ids[4 * start:4 * (start + length)])
            at += length
        assert at == len(np.frombuffer(ids, "<u4"))
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= packing.LIMIT
