"""Each operator against a brute-force version on small inputs."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from studylake.llm import (byte_cnn, lattice, licenses, lstm_crf, minhash, mixing, packing, pii, quality_rules, secrets,
                           sharding, tokens, words)

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r["doc_id"]: r["text"] or "" for r in docs.collect()}


def lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t)


def test_tokens_equal_whole_text_encoding(texts):
    e = tokens.Encoder(tokens.default_path())
    odd = ["it's don't x2y3 ﬁne Ångström İstanbul ΣΑΣ", "a b\x1cd\x85e \x0bf", "<|endoftext|> hi", "naïve—test 12.5% $$$ !!??", "日本 🙂", ""]
    for t in [*list(texts.values())[:60], *odd]:
        want = e.tokenizer.encode(t, add_special_tokens=False).ids
        assert np.frombuffer(e.batch([t])[0], "<u4").tolist() == want


def test_packing_is_a_gapless_round_trip(docs, texts):
    rows = packing.pack(docs).collect()
    e = tokens.Encoder(tokens.default_path())
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_seq[r["sequence_id"]].append((r["offset"], r["length"]))
    for i, t in texts.items():
        ids = e.batch([t])[0] + b"\0\0\0\0"
        for r in sorted(by_doc[i], key=lambda r: r["piece"]):
            assert r["ids_crc32"] == zlib.crc32(ids[4 * r["start"]:4 * (r["start"] + r["length"])])
        assert sum(r["length"] for r in by_doc[i]) == len(ids) // 4
    for places in by_seq.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= packing.LIMIT
    total = sum(r["length"] for r in rows)
    assert len(by_seq) <= -(-total // packing.LIMIT) * 1.01 + 1


def test_plan_over_counts_places_every_piece():
    rng = random.Random(5)
    for limit in (10, 64):
        counts = {n: rng.randint(1, 300) for n in rng.sample(range(1, limit + 1), limit // 2)}
        used, ranks = defaultdict(list), defaultdict(set)
        for length, first, n, seq, offset in packing.plan(counts, limit):
            for i in range(n):
                assert first + i not in ranks[length]
                ranks[length].add(first + i)
                used[seq + i].append((offset, length))
        assert {k: len(v) for k, v in ranks.items()} == counts
        for places in used.values():
            at = 0
            for offset, length in sorted(places):
                assert offset == at
                at += length
            assert at <= limit


def test_sharding_near_equal_bytes(docs, texts):
    rows = sharding.shard(docs, shards=8).collect()
    size, slots = Counter(), defaultdict(list)
    for r in rows:
        t = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"]) == (len(t) + 16, zlib.crc32(t), "bytes")
        size[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert sorted(size) == list(range(8))
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert max(size.values()) - min(size.values()) <= 2 * max(r["size"] for r in rows)


def test_sharding_splits_a_hot_text(spark):
    df = spark.range(20_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("same " * 40)).otherwise(
        F.concat(F.lit("text "), F.col("id").cast("string"), F.lit(" x" * 90))).alias("text"))
    size = {r["shard"]: r["b"] for r in sharding.shard(df).groupBy("shard").agg(F.sum("size").alias("b")).collect()}
    mean = sum(size.values()) / 40
    assert len(size) == 40 and max(abs(v - mean) for v in size.values()) < 0.01 * mean


def test_sharding_numbers_hot_ranges_in_key_order(spark, monkeypatch):
    monkeypatch.setattr(sharding, "RANGE_ROWS", 200)
    df = spark.range(6_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("same")).otherwise(
        F.concat(F.lit("text "), F.col("id").cast("string"))).alias("text"))
    key = {r["doc_id"]: r["key"] for r in sharding.keyed(df).collect()}
    slots = defaultdict(dict)
    for r in sharding.shard(df, shards=5).collect():
        slots[r["shard"]][r["slot"]] = key[r["doc_id"]]
    in_order = [slots[s][i] for s in range(5) for i in range(len(slots[s]))]  # gapless, sorted within and over shards
    assert in_order == sorted(key.values())
    own = sharding.ranges(sharding.keyed(df).withColumn("shard", F.lit(0)), 6_000).groupBy("range").count()
    assert own.agg(F.max("count")).first()[0] < 1000  # the hot text has 2,000 rows


def test_mixing_meets_targets(docs, texts):
    rows = mixing.mix(docs).collect()
    again = {(r["doc_id"], r["taken"]) for r in mixing.mix(docs.repartition(7)).collect()}
    assert {(r["doc_id"], r["taken"]) for r in rows} == again
    size, taken, goal, total = Counter(), Counter(), {}, 0
    for r in rows:
        assert r["size"] == len(WORD.findall(texts[r["doc_id"]]))
        assert r["taken"] in (0, r["size"], 2 * r["size"])
        size[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        goal[r["source"]] = r["target"]
        total += r["size"]
    assert abs(sum(goal.values()) - 1.5 * total) < 1e-6 * total
    for s in goal:
        assert goal[s] <= 2 * size[s] + 1e-9
        assert abs(goal[s] - taken[s]) <= max(3, 0.02 * goal[s])


def test_knapsack_is_exact_when_it_can_be():
    rng = np.random.default_rng(3)
    for _ in range(30):
        lengths = np.sort(rng.choice(np.arange(1, 40), 8, replace=False))
        counts = rng.integers(1, 9, 8)
        budget = int(rng.integers(1, (lengths * counts).sum()))
        take = mixing.fit(lengths, counts, budget)
        assert (take >= 0).all() and (take <= counts).all() and (lengths * take).sum() <= budget
        if lengths[0] == 1 and counts[0] >= 8:
            assert budget - (lengths * take).sum() <= 1


def test_knapsack_of_few_long_texts():
    five = np.array([78_000, 79_000, 80_000, 81_000, 82_000])
    rng = np.random.default_rng(4)
    cases = [(five, 200_000), (five, 300_000), (np.array([3, 5]).repeat(2), 10)]
    cases += [(np.sort(rng.integers(60_000, 400_000, 9)), int(rng.integers(50_000, 2_500_000))) for _ in range(25)]
    for each, budget in cases:
        sums = np.array([0])
        for n in each:
            sums = np.concatenate([sums, sums + n])
        lengths, counts = np.unique(each, return_counts=True)
        take = mixing.fit(lengths, counts, budget)
        assert (take >= 0).all() and (take <= counts).all()
        assert (lengths * take).sum() == sums[sums <= budget].max()


def test_knapsack_of_texts_beyond_its_cells():
    rng = np.random.default_rng(6)
    for most in (9_000_000, 3_000_000_000):  # over rounded lengths: near, though not to the word
        each = np.sort(rng.integers(most // 2, most, 8))
        sums = np.array([0])
        for n in each:
            sums = np.concatenate([sums, sums + n])
        for budget in (int(1.2 * most), int(2.7 * most)):
            taken = int((each * mixing.fit(each, np.ones(8, np.int64), budget)).sum())
            assert 0 <= sums[sums <= budget].max() - taken <= 1e-4 * budget
    many = np.unique(rng.integers(60_000, 100_000, 3000))
    assert int((many * mixing.fit(many, np.ones(len(many), np.int64), 120_000_000)).sum()) == 120_000_000


def test_licenses_base(docs, texts):
    for r in licenses.scan(docs).collect():
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(texts[r["doc_id"]]))
        places = [(i, label) for p, label in licenses.BASE for i in range(len(w)) if w[i:i + len(p.split())] == p.split()]
        assert r["n_words"] == len(w) and r["n_base"] == len(places)
        assert r["first_word"] == min((i for i, _ in places), default=None)
        assert r["last_word"] == max((i for i, _ in places), default=None)
        assert r["base_labels"] == ",".join(sorted({x for _, x in places}))
        assert set(filter(None, r["base_labels"].split(","))) <= set(filter(None, r["labels"].split(",")))
        assert 0 <= r["score"] <= 1


def test_licenses_of_the_method(spark, docs):
    more = spark.createDataFrame([
        (9001, "x y z Redistribution and use in source and binary forms, with or without modification, are permitted provided that"),
        (9002, "cc by nc cc by nc and the CC-BY-NC"), (9003, "the general public of the world under a version")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in licenses.scan(docs.select("doc_id", "text").unionByName(more)).filter("doc_id > 9000").collect()}
    assert got[9001]["labels"] == "bsd" and got[9001]["score"] > 0.4
    assert (got[9002]["n_base"], got[9002]["first_word"], got[9002]["last_word"]) == (3, 0, 8)
    assert got[9003]["labels"] == "" and got[9003]["score"] == 0


def notice(label, at=0):
    return [t for x, t, _ in licenses.TEMPLATES if x == label][at]


def test_licenses_of_files_with_several_notices(spark):
    fill = " ".join(f"word{i}" for i in range(300))
    every = " ".join(licenses.VOCABULARY)
    files = [("mit", "bsd"), ("mit", "isc"), ("mit", "bsd", "isc"), ("gpl", "mit", "bsd", "isc", "unlicense", "cc0")]
    rows = [(i, f" {fill} ".join(notice(x) for x in labels)) for i, labels in enumerate(files)]
    rows += [(10, f"{every} {fill} {notice('proprietary')} {fill}"), (11, f"{every} {fill} {notice('isc')}"), (12, every)]
    rows += [(100 + i, f"{fill} {i}") for i in range(200)]
    got = {r["doc_id"]: r["labels"] for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[i] for i in range(len(files))] == [",".join(sorted(x)) for x in files]
    assert (got[10], got[11], got[12]) == ("proprietary", "isc", "") and all(got[i] == "" for i in range(100, 300))


@pytest.mark.parametrize("n", [19, 20, 300])
def test_licenses_of_a_notice_in_a_third_of_the_rows(spark, n):
    hot = notice("gpl")
    rows = [(i, f"file {i} {hot} end" if i % 3 == 0 else f"prose of {i} and the rest of it") for i in range(n)]
    rows += [(1000, notice("lgpl")), (1001, notice("agpl-3")), (1002, "the terms of the general public and free software")]
    got = {r["doc_id"]: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[i]["labels"] for i in range(n)] == ["gpl" if i % 3 == 0 else "" for i in range(n)]
    assert all(got[i]["score"] == 1.0 for i in range(0, n, 3))
    assert [got[i]["labels"] for i in (1000, 1001, 1002)] == ["lgpl", "agpl-3", ""]


def plain_labels(text, rarest):
    """Labels of the method, template by template and offset by offset."""
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
    out = {label for phrase, label in licenses.BASE if f" {phrase} " in f" {' '.join(w)} "}
    for t, (label, template, phrases) in enumerate(licenses.TEMPLATES):
        own = template.split()
        short = len(own) <= licenses.SHORT
        for off in range(-len(own), len(w)):
            at = [p for p in range(len(own)) if 0 <= off + p < len(w) and w[off + p] == own[p]]
            if (len(at) >= (licenses.MOST_OF_SHORT if short else licenses.MOST_OF_LONG) * len(own)
                    and sum(own[p] in rarest[t] for p in at) >= max(2, licenses.AGREE * len(rarest[t]))
                    and licenses._KEYS[t] <= set(at) and not (off > 0 and w[off - 1] in licenses.NEGATIONS)
                    and (short or all(f" {x} " in f" {' '.join(w)} " for x in phrases))):
                out.add(label)
    return ",".join(sorted(out))


def test_licenses_equal_a_plain_search_by_offset(spark):
    rng = random.Random(11)
    pieces = [t.split() for _, t, _ in licenses.TEMPLATES]

    def text():
        out = []
        for _ in range(rng.randrange(1, 5)):
            own = list(rng.choice(pieces))
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                k = rng.randrange(len(own))
                own[k:k + 1] = rng.choice([[], ["other"], [own[k], "more"], [rng.choice(licenses.VOCABULARY)]])
            out += [rng.choice(["not", "word", "the", "under", "never", "file"]) for _ in range(rng.randrange(3))] + own
        return " ".join(out)

    rows = [(i, text()) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    rarest = licenses.signatures(*licenses.document_counts(df))
    got = {r["doc_id"]: r["labels"] for r in licenses.scan(df).collect()}
    assert [(i, got[i]) for i, _ in rows] == [(i, plain_labels(t, rarest)) for i, t in rows]


def test_licenses_need_the_notice_not_its_phrase(spark):
    real = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including")
    cases = [("we compared the mit license with others", ""), ("there are not all rights reserved here", ""),
             ("all rights reserved", "proprietary"), ("the gnu general public license has a version 3 and a version 2", ""),
             ("this code is never licensed under cc by sa 4 0 terms", ""), ("Licensed under CC-BY-SA 4.0.", "cc-by-sa"),
             ("the public domain and unencumbered software", ""), (real, "mit"), (real.replace("free of charge", "at a price"), ""),
             (" ".join(reversed(notice("bsd").split())) + " redistribution and use in source and binary forms", ""),
             ("This work is licensed under the GNU General Public License, version 2; Python version 3", "gpl-2"), (notice("bsd"), "bsd")]
    rows = [(i, t) for i, (t, _) in enumerate(cases)] + [(100 + i, f"prose of {i} and the rest") for i in range(50)]
    got = {r["doc_id"]: r["labels"] for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [(t, got[i]) for i, (t, _) in enumerate(cases)] == cases
    assert all(got[100 + i] == "" for i in range(50))


def test_secrets(spark, docs, texts):
    rng = random.Random(1)
    alnum = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    rand = lambda n: "".join(rng.choice(alnum) for _ in range(n))
    extra = [(9000 + i, f"see {rand(44)} there") for i in range(10)] + [
        (9100, "secret: token: abcdefghij"), (9101, "ÀÉ API-KEY api_key='abcdefgh' apikey=abc"),
        (9102, "averyveryverylongwordwithnothinginit_and_2024_more of_these_words_here_too_1999")]
    rows = docs.select("doc_id", "text").unionByName(spark.createDataFrame(extra, "doc_id long, text string"))
    texts = texts | dict(extra)
    assign = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    for r in secrets.report(rows).collect():
        t = texts[r["doc_id"]]
        found = [(m.start(), 0, m.end()) for m in assign.finditer(t) if len(m[2]) >= 8]
        found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
        found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 32]
        text = ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in sorted(found))
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(sum(k == x for _, k, _ in found) for x in range(3))
        assert r["base_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert set(filter(None, text.split(","))) <= set(r["spans"].split(","))
        if 9000 <= r["doc_id"] < 9100:
            assert r["spans"] == "random:4:48"
        if r["doc_id"] == 9102:
            assert r["spans"] == ""


def shingles(t, width):
    w = WORD.findall(lower(t))
    return frozenset(zip(*[w[k:] for k in range(width)])) if len(w) >= width else frozenset([tuple(w)] if w else [])


@pytest.mark.parametrize("width", [4, 5])
def test_minhash_components_equal_all_pairs(spark, docs, texts, width):
    rng = random.Random(width)
    words = [f"w{i}" for i in range(3000)]
    base = [rng.choice(words) for _ in range(150)]
    near = []
    for i in range(150):  # a large group of near copies, a chain among them
        own = list(base)
        for _ in range(rng.randint(0, 8)):
            own[rng.randrange(150)] = rng.choice(words)
        near.append((20_000 + i, " ".join(own)))
    chain = list(base[:100])
    for i in range(20):
        chain[rng.randrange(100)] = rng.choice(words)
        near.append((21_000 + i, " ".join(chain)))
    near += [(22_000, "one two"), (22_001, "One  TWO"), (22_002, "ÉA b"), (22_003, "éa b")]
    rows = docs.select("doc_id", "text").unionByName(spark.createDataFrame(near, "doc_id long, text string"))
    sets = {i: shingles(t, width) for i, t in [*texts.items(), *near]}
    par = {i: i for i in sets}

    def find(x):
        while par[x] != x:
            x = par[x]
        return x

    ids = sorted(i for i in sets if sets[i])
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            x, y = sets[a], sets[b]
            if min(len(x), len(y)) * 100 >= 80 * max(len(x), len(y)):
                both = len(x & y)
                if 100 * both >= 80 * (len(x) + len(y) - both):
                    p, q = find(a), find(b)
                    par[max(p, q)] = min(p, q)
    got = {r["doc_id"]: r for r in minhash.near_duplicates(rows, width=width).collect()}
    assert {i: r["component_id"] for i, r in got.items()} == {i: find(i) for i in sets}
    assert all(r["n_shingles"] == len(sets[i]) and r["kept"] == (i == find(i)) for i, r in got.items())


def test_minhash_tasks_follow_the_repeated_text(spark, monkeypatch):
    # a cluster with a component of 40 and 160 documents outside of it, 20 characters each
    rows = spark.createDataFrame([(i, 1, 0 if i < 40 else i, 0, 20, 16) for i in range(200)],
                                 "id long, cluster long, comp long, top long, blocks int, out_blocks int")
    texts = rows.select("id", F.lit("x" * 20).alias("text"))
    monkeypatch.setattr(minhash, "TASK_CHARS", 100)
    assert minhash._open_tasks(rows, texts) == (200 * 16 + 160 * 20) * 20 // 100
    assert minhash._open_tasks(rows.limit(0), texts) == 256


def test_quality_rules(spark, docs, texts):
    lab = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    wrong = 0
    for r in quality_rules.judge(docs).collect():
        t = texts[r["doc_id"]]
        w = WORD.findall(t)
        five = Counter(zip(*[w[k:] for k in range(5)]))
        inside = {i + k for i in range(len(w) - 4) if five[tuple(w[i:i + 5])] > 1 for k in range(5)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        assert (r["n_words"], r["word_chars"], r["n_repeat_words"]) == (len(w), sum(map(len, w)), len(inside))
        assert (r["n_symbols"], r["n_dup_lines"]) == (len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)))
        assert r["base_failed"] == (len(w) < 10 or 100 * len(inside) > 20 * len(w))
        if r["base_failed"]:
            assert not r["kept"]
        elif r["doc_id"] in lab:
            wrong += r["kept"] != bool(lab[r["doc_id"]])
    assert wrong <= 2


def plain_em(patterns, false_blame, rounds):
    """The model of quality_rules, one document class, rule and pattern at a time."""
    q = quality_rules
    rules, total = len(false_blame), sum(patterns.values())
    said = lambda j, c: sum(n for k, n in patterns.items() if k[j] == c)
    quiet = [(said(j, "-") + 1) / (said(j, "1") + said(j, "-") + 2) for j in range(rules)]
    share = [1 - q.P_BAD] + [q.P_BAD / rules] * rules
    mean = [[q.FALSE_BLAME] * rules] + [[q.FOUND if j == k else q.ALSO_FOUND for j in range(rules)] for k in range(rules)]
    weigh = [[q.BLAME_WEIGHT] * rules] + [[q.FOUND_WEIGHT if j == k else q.WEAK for j in range(rules)] for k in range(rules)]
    blamed, silent, classes = [list(false_blame), *map(list, mean[1:])], [list(quiet) for _ in share], list(share)

    def chance(c, key):
        out = classes[c]
        for j, x in enumerate(key):
            b, s = blamed[c][j], silent[c][j]
            out *= b if x == "0" else (1 - b) * (s if x == "-" else 1 - s)
        return out

    for _ in range(rounds):
        of = {k: [n * chance(c, k) / sum(chance(d, k) for d in range(rules + 1)) for c in range(rules + 1)] for k, n in patterns.items()}
        for c in range(rules + 1):
            each = sum(x[c] for x in of.values())
            classes[c] = (each + q.CLASS_WEIGHT * total * share[c]) / (total * (1 + q.CLASS_WEIGHT))
            for j in range(rules):
                bad = sum(x[c] for k, x in of.items() if k[j] == "0")
                none = sum(x[c] for k, x in of.items() if k[j] == "-")
                w, h = weigh[c][j] * total, q.SILENT_WEIGHT * total
                blamed[c][j] = (bad + w * mean[c][j]) / (each + w)
                silent[c][j] = (none + h * quiet[j]) / (each - bad + h)
    return {k: chance(0, k) / sum(chance(c, k) for c in range(rules + 1)) for k in patterns}


def test_expectation_maximisation_equals_a_plain_version():
    patterns = {"111": 700, "011": 60, "101": 31, "001": 40, "1-1": 90, "-10": 12, "--0": 3, "0--": 8}
    keys = sorted(patterns)
    n = np.array([patterns[k] for k in keys], float)
    v = np.array([["01-".index(c) for c in k] for k in keys])
    for start, rounds in (([0.002] * 3, 1), ([0.002] * 3, 7), ([0.11, 0.002, 0.02], 30)):
        good, _ = quality_rules._em(n, v, np.array(start), rounds)
        want = plain_em(patterns, start, rounds)
        assert np.allclose(good, [want[k] for k in keys])
    goals = [quality_rules._em(n, v, np.array([0.002] * 3), r)[1] for r in range(12)]
    assert all(b >= a - 1e-9 for a, b in zip(goals, goals[1:]))  # no round lowers the log posterior


def votes_with(at, part):
    """10,000 documents: four kinds of bad ones, and one rule that blames a part of all at random."""
    of = {"1" * 8: 8500, "10111111": 600, "11011110": 400, "1101001-": 400, "-1111111": 100}
    out = Counter()
    for k, c in of.items():
        out[k] += round(c * (1 - part))
        out[k[:at] + "0" + k[at + 1:]] += round(c * part)
    return dict(out)


@pytest.mark.parametrize("at", [0, 3, 5, 6])
def test_the_posterior_overrules_an_unreliable_rule(at):
    alone = "1" * at + "0" + "1" * (7 - at)
    trusted, noisy = quality_rules.fit(votes_with(at, 0.05)), quality_rules.fit(votes_with(at, 0.35))
    assert trusted[alone] < 0.5 <= noisy[alone]
    for p in (trusted, noisy):
        assert p["1" * 8] >= 0.5 and p["-1111111"] >= 0.5
        assert all(p[k] < 0.5 for k in ("10111111", "11011110", "1101001-") if k[at] != "0")
    tenfold = quality_rules.fit({k: 10 * c for k, c in votes_with(at, 0.35).items()})
    assert all(abs(tenfold[k] - noisy[k]) < 1e-3 for k in noisy)


def test_variety_does_not_depend_on_length():
    rng = random.Random(8)
    few, many = [f"w{i}" for i in range(100)], [f"w{i}" for i in range(2500)]
    lengths = [1999, 2000, 2001, 3999, 4000, 9001, 70_000]
    texts = [" ".join(rng.choice(v) for _ in range(n)) for v in (few, many) for n in lengths]
    votes = [v[quality_rules.RULES.index("variety")] for v in quality_rules.measure(pd.Series(texts))["votes"]]
    assert votes == ["0"] * len(lengths) + ["1"] * len(lengths)
    for n in (39, 40, 500, 1999, 2000, 2001, 4000, 5003):
        w = [rng.choice(few) for _ in range(n)]
        starts = [0] if n <= 2000 else [*range(0, n - 1999, 2000), *([n - 2000] if n % 2000 else [])]
        share = np.mean([len(set(w[k:k + 2000])) / len(w[k:k + 2000]) for k in starts])
        block = next(iter(words.blocks([b"", " ".join(w).encode(), b"one"])))
        assert np.allclose(quality_rules._variety(block), [0, share, 1])


def test_byte_cnn_learns_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    lab = spark.read.parquet(f"{sf}/labels.parquet")
    out = byte_cnn.classify(spark.read.parquet(f"{sf}/documents.parquet"), lab)
    rows = out.join(lab.select("doc_id", "quality"), "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    assert all(r["predicted"] == (r["score"] >= 0.5) and 0 <= r["score"] <= 1 for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["predicted"] == r["quality"] for r in held) / len(held) >= 0.93


def test_byte_cnn_chunks_cover_everything():
    for n in (0, 1, 511, 512, 513, 960, 961, 5000):
        data = bytes(1 + i % 250 for i in range(n))
        parts, step = byte_cnn.chunks_of(data), byte_cnn.CHUNK - byte_cnn.OVERLAP
        back = bytearray(max(n, 1) + byte_cnn.CHUNK)
        for k, p in enumerate(parts):
            back[k * step:k * step + byte_cnn.CHUNK] = p.tobytes()
        assert bytes(back[:n]) == data


def test_crf_gradients():
    rng = np.random.default_rng(0)
    p = lstm_crf.init(5, 1)
    x, y = rng.integers(0, lstm_crf.N_CHARS, (3, 6)), rng.integers(0, 5, (3, 6))
    _, g = lstm_crf.gradients(p, x, y)
    for k in p:
        at = (x[0, 2], 3) if k[0] == "x" else tuple(0 for _ in p[k].shape)
        old, d = p[k][at], 1e-5
        p[k][at] = old + d
        up = lstm_crf.gradients(p, x, y)[0]
        p[k][at] = old - d
        down = lstm_crf.gradients(p, x, y)[0]
        p[k][at] = old
        assert abs((up - down) / (2 * d) - g[k][at]) < 1e-6


def test_crf_posteriors_and_paths_equal_enumeration():
    rng = np.random.default_rng(6)
    e, move = rng.normal(0, 2, (4, 5, 3)), rng.normal(0, 1, (3, 3))
    post, path, old = lstm_crf.posteriors(e, move), lstm_crf.viterbi(e, move), lstm_crf.marginals(e, move)[3]
    for r in range(4):
        scores = {y: sum(e[r, t, y[t]] for t in range(5)) + sum(move[y[t - 1], y[t]] for t in range(1, 5))
                  for y in itertools.product(range(3), repeat=5)}
        z = sum(np.exp(x) for x in scores.values())
        assert tuple(path[r]) == max(scores, key=scores.get)
        for t, k in itertools.product(range(5), range(3)):
            assert abs(post[r, t, k] - sum(np.exp(x) for y, x in scores.items() if y[t] == k) / z) < 1e-9
    assert np.allclose(post, old)
    long = lstm_crf.posteriors(np.full((1, 30_000, 3), 30, np.float32), move.astype(np.float32))
    assert np.isfinite(long).all() and np.allclose(long.sum(2), 1, atol=1e-3)


BASE = [re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
        re.compile(r"[0-9]([\x20-]?[0-9])+"), re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")]


def brute_pii(t):
    out = []
    for k, pattern in enumerate(BASE):
        for m in pattern.finditer(t):
            d = re.sub(r"[^0-9]", "", m[0])
            if k == 1 and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if k == 2 and not (12 <= len(d) <= 19 and pii._luhn(d)) or k == 3 and not 9 <= len(d) <= 15:
                continue
            out.append((m.start(), k, m.end()))
    return sorted(out)


def test_pii_base_equals_patterns():
    rng = random.Random(2)
    for _ in range(5000):
        t = "".join(rng.choice("a.@1 2-+()%_9b@..") for _ in range(40))
        assert pii.base_spans(t) == brute_pii(t)
    pii.base_spans("1" * 200_000 + "." + "a" * 200_000 + "@")  # stays linear


def test_pii_report(docs, texts):
    for r in pii.report(docs).collect():
        base = brute_pii(texts[r["doc_id"]])
        text = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in base)
        assert (r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]) == tuple(sum(k == x for _, k, _ in base) for x in range(4))
        assert r["base_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert set(filter(None, text.split(","))) <= set(r["spans"].split(","))


def test_pii_model_finds_base_spans_by_itself(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    p = pii.fit(docs)
    texts = [r["text"] for r in docs.collect()]
    model = pii.decode(p, texts)
    base = [pii.base_spans(t) for t in texts]
    n = sum(map(len, base))
    assert sum(len(set(a) & set(b)) for a, b in zip(base, model, strict=True)) >= 0.8 * n
    added = sum(not any(b[0] < s[2] and s[0] < b[2] for b in own) for own, m in zip(base, model, strict=True) for s in m)
    assert added <= 0.05 * n


def test_pii_windows_equal_a_plain_search():
    rng = random.Random(5)
    for n in [0, 1, 15, 16, 31, 32, 33, 47, 48, 49, 64, *(rng.randrange(400) for _ in range(200))]:
        t = "".join(rng.choice("ab \u00e9\U0001f642" + "7@" * (rng.random() < 0.02)) for _ in range(n))
        want = [s for s in range(0, n, pii.STEP) if re.search("[0-9@]", t[s:s + pii.WINDOW])]
        assert pii.window_starts(t).tolist() == want


@pytest.fixture(scope="module")
def pii_model(spark):
    return pii.fit(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def test_pii_adds_spans_of_its_own(pii_model):
    texts = [f"please call ({200 + i}) 555-{1000 + 37 * i} now" for i in range(60)] + ["nothing to see in 2 or 3 words"] * 20
    found = pii.spans(pii_model, texts)
    assert all(not base for base, _ in found)
    assert sum((12, 3, 26) in more for _, more in found[:60]) >= 30
    assert not any(more for _, more in found[60:])


def test_pii_of_long_texts_in_segments(pii_model, monkeypatch):
    rng = random.Random(7)
    phone = lambda: f"+{rng.randrange(10, 99)} ({rng.randrange(200, 999)}) {rng.randrange(200, 999)}-{rng.randrange(1000, 9999)}"
    word = lambda: rng.choice(["word", "3 of", "in 2024", "no. 7", "text", "12%"])
    text = " ".join(phone() if k % 9 == 0 else word() for k in range(4000))
    parts = pii._segments(pii.window_starts(text), len(text))
    assert len(parts) > 5 and max(e - f for _, f, e, _, _ in parts) <= (pii.OWN + 2 * pii.BESIDE) * pii.STEP + pii.WINDOW
    assert [p[3] for p in parts[1:]] == [p[4] for p in parts[:-1]]
    pieces = pii.decode(pii_model, [text])[0]
    monkeypatch.setattr(pii, "OWN", 1 << 30)
    whole = pii.decode(pii_model, [text])[0]
    assert len(whole) > 300 and len(set(pieces) ^ set(whole)) <= 0.005 * len(whole)
    monkeypatch.undo()
    digits = "".join(rng.choice("0123456789") for _ in range(300_000))
    tracemalloc.start()
    pii.decode(pii_model, [digits])
    top = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert top < 200 << 20


def test_lattice_points():
    rng = np.random.default_rng(1)
    x = rng.normal(0, 2, (500, 8))
    points = lattice.decode(x)
    whole = (points == np.rint(points)).all(1)
    assert ((points[whole].sum(1) % 2) == 0).all() and (((points[~whole] - 0.5).sum(1) % 2) == 0).all()
    assert (((x - points) ** 2).sum(1) <= 1 + 1e-9).all()  # the covering radius is one
    near = ((x[:, None] - (points[:, None] + lattice.ROOTS[None])) ** 2).sum(2).min(1)
    assert (((x - points) ** 2).sum(1) <= near + 1e-9).all()


def test_lattice_links_equal_all_pairs(spark):
    rng = np.random.default_rng(2)
    v = rng.normal(size=(400, 64))
    v[:60] = v[0] + rng.normal(0, 0.12, (60, 64)) * np.linspace(0.5, 2.2, 60)[:, None]
    v[60:70] = v[60]
    rows = [(i, [float(x) for x in r]) for i, r in enumerate(v.astype(np.float32))]
    got = {r["vec_id"]: r for r in lattice.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()}
    u = v.astype(np.float32).astype(float)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    link = u @ u.T >= 0.95
    np.fill_diagonal(link, False)
    assert [got[i]["n_links"] for i in range(400)] == link.sum(1).tolist()
    low = np.arange(400)
    for _ in range(400):
        low = np.where(link, low[None], low[:, None]).min(1).clip(max=low)
    assert [got[i]["component_id"] for i in range(400)] == low.tolist()


def test_lattice_links_vectors_of_every_length(spark):
    rng = np.random.default_rng(7)
    rows, at = [], 0
    for dim, n in ((64, 120), (48, 60), (3, 20), (1, 4)):
        v = rng.normal(size=(n, dim))
        v[: n // 2] = v[0] + rng.normal(0, 0.1, (n // 2, dim))
        rows += [(at + i, [float(x) for x in r]) for i, r in enumerate(v.astype(np.float32))]
        at += n
    links, low = Counter(), {i: i for i, _ in rows}
    unit = [np.array(v) / np.linalg.norm(v) for _, v in rows]
    pairs = [(a, b) for a in range(at) for b in range(a) if len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.95]
    for a, b in pairs:
        links[a] += 1
        links[b] += 1
    for _ in range(at):
        old = dict(low)
        for a, b in pairs:
            low[a] = low[b] = min(low[a], low[b])
        if old == low:
            break
    got = {r["vec_id"]: r for r in lattice.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()}
    assert [got[i]["n_links"] for i in range(at)] == [links[i] for i in range(at)]
    assert [got[i]["component_id"] for i in range(at)] == [low[i] for i in range(at)]
    twice = [(1, [1.0, 0.0, 0.5]), (1, [1.0, 0.0]), (2, [1.0, 0.01, 0.5]), (3, [1.0, 0.01])]
    out = lattice.near_duplicates(spark.createDataFrame(twice, "vec_id long, embedding array<float>")).collect()
    assert sorted((r["vec_id"], r["component_id"]) for r in out) == [(1, 1), (1, 1), (2, 1), (3, 1)]
