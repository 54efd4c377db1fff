"""License scans by a positional rare-token index, with DataFrame functions only.

Templates of license notices are indexed by word and position. All documents
give the document counts of the license words, and each template is known by its
rarest words that any document has, by rank, however frequent they are. A file's
license words are looked up in this index, and a template is a candidate where
enough of its rarest words are there. Then every place of the candidates' words
in the text and every posting of them vote for the offset between the two. A
template is reported where, at one offset, half of its rarest words, most of its
words (four in five of a short notice, three in five of a long one) and its
mandatory key phrase stand at their places, and no negation stands before it; the
other key phrases of a long notice may stand elsewhere, since words put into a
notice shift what follows. A key phrase in a sentence that is no notice
gives no label. Base phrases are found besides, wherever their words stand
consecutively.

All the work on a text happens in its own row, so no word, however frequent,
gathers anything; the only exchange counts the license words.

Nulls and odd rows: a null text counts as empty (no words, no labels, score 0);
a null doc_id is carried through; each input row gives one output row, repeated
rows included; other columns are ignored, whatever their names; an empty table
gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from studylake.llm.common import let, lower_ascii, text_of

# Base phrases and their labels.
BASE = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))

# Opening words of public license notices, label and mandatory key phrases.
TEMPLATES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files to deal in the software without restriction",
     ("permission is hereby granted free of charge", "without restriction")),
    ("mit", "released under the mit license", ("mit license",)),
    ("apache-2", "licensed under the apache license version 2 0 you may not use this file except in compliance with the license", ("apache license version 2",)),
    ("apache-2", "licensed under the apache license version 2 0", ("apache license version 2",)),
    ("gpl-3", "this work is licensed under the gnu general public license version 3", ("gnu general public license", "version 3")),
    ("gpl-2", "this work is licensed under the gnu general public license version 2", ("gnu general public license", "version 2")),
    ("gpl", "free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation",
     ("gnu general public license", "free software foundation")),
    ("lgpl", "under the terms of the gnu lesser general public license as published by the free software foundation", ("gnu lesser general public license",)),
    ("agpl-3", "under the terms of the gnu affero general public license as published by the free software foundation", ("gnu affero general public license",)),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
     ("redistribution and use in source and binary forms",)),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
     ("permission to use copy modify and or distribute this software",)),
    ("unlicense", "this is free and unencumbered software released into the public domain", ("unencumbered software", "public domain")),
    ("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    ("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license", ("creative commons attribution noncommercial",)),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license", ("creative commons attribution 4 0",)),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights cc0", ("waived all copyright",)),
    ("proprietary", "all rights reserved", ("all rights reserved",)),
)

#: A template is looked up by so many of its rarest words, of which this part must agree
#: on an offset, two at least.
RAREST, AGREE = 6, 0.5
#: Part of a template's words that must stand at one offset: of templates of at
#: most SHORT words, and of longer ones.
SHORT, MOST_OF_SHORT, MOST_OF_LONG = 12, 0.8, 0.6
#: Words before a notice that turn it into its contrary.
NEGATIONS = ("never", "not")

_WORDS = [t.split() for _, t, _ in TEMPLATES]
VOCABULARY = sorted({w for ws in _WORDS for w in ws})
_VOTE = "array<struct<t:int,n:int>>"


def normal(text: Column) -> Column:
    """Lower-case words with one space between."""
    return F.trim(F.regexp_replace(lower_ascii(text), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " "))


def _spaces(text: Column) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))).cast("long")


def _contains(padded: Column, phrase: str) -> Column:
    return F.contains(padded, F.lit(f" {phrase} "))


def _strings(values: list[str]) -> Column:
    return F.split(F.lit(" ".join(values)), " ")


def document_counts(docs: DataFrame) -> tuple[int, dict[str, int]]:
    """All documents, and those that have each license word (one row per word)."""
    words = F.split(normal(text_of("text")), " ")
    present = docs.select(F.array_append(F.array_intersect(words, _strings(VOCABULARY)), F.lit("")).alias("ws"))
    found = {r["w"]: r["count"] for r in present.select(F.explode("ws").alias("w")).groupBy("w").count().collect()}
    return found.pop("", 0), found


def signatures(total: int, counts: dict[str, int]) -> list[list[str]]:
    """The rarest words of each template, highest inverse document frequency
    first; words that no document has cannot be looked up."""
    idf = {w: math.log((total + 1) / (counts[w] + 1)) for w in VOCABULARY if counts.get(w)}
    return [sorted(set(ws) & set(idf), key=lambda w: (-idf[w], w))[:RAREST] for ws in _WORDS]


def _key_places(template: int) -> set[int]:
    """Places of the key phrases that must stand at the offset: of a short
    template all, of a long one the first."""
    _, text, phrases = TEMPLATES[template]
    words, out = text.split(), set()
    for phrase in phrases if len(words) <= SHORT else phrases[:1]:
        ws = phrase.split()
        at = next(i for i in range(len(words)) if words[i:i + len(ws)] == ws)
        out |= set(range(at, at + len(ws)))
    return out


_KEYS = [_key_places(t) for t in range(len(TEMPLATES))]


def _least(signature: list[str]) -> int:
    return max(2, math.ceil(AGREE * len(signature)))


def _candidates(found: Column, rarest: list[list[str]]) -> Column:
    """Numbers of the templates of whose rarest words enough are among the found ones."""
    held = [F.when(F.size(F.array_intersect(_strings(ws), found)) >= _least(ws), F.lit(t))
            for t, ws in enumerate(rarest) if len(ws) > 1]
    return F.array_compact(F.array(*held)) if held else F.array().cast("array<int>")


def _votes(words: Column, candidates: Column, rarest: list[list[str]]) -> Column:
    """(template, most words at one offset) of each candidate that has such an
    offset with enough words, rare ones and key phrases and no negation before."""
    postings: dict[str, list[tuple[int, int]]] = {w: [] for w in {*VOCABULARY, *NEGATIONS}}
    for t, ws in enumerate(_WORDS):
        for p, w in enumerate(ws):
            postings[w].append((t, p))
        for w in NEGATIONS:
            postings[w].append((t, -1))
    posting = lambda w, t, p: F.struct(
        F.lit(t).alias("t"), F.lit(p).alias("p"), F.lit(int(p >= 0 and w in rarest[t])).alias("rare"),
        F.lit(int(p in _KEYS[t])).alias("key"))
    index = F.create_map(*[x for w in sorted(postings) for x in (F.lit(w), F.array(*[posting(w, t, p) for t, p in postings[w]]))])
    most = [MOST_OF_SHORT if len(ws) <= SHORT else MOST_OF_LONG for ws in _WORDS]
    needed = F.array(*[F.struct(F.lit(math.ceil(most[t] * len(ws))).alias("n"), F.lit(_least(rarest[t])).alias("rare"),
                                F.lit(len(_KEYS[t])).alias("key")) for t, ws in enumerate(_WORDS)])
    of_template = F.array(*[_strings(sorted({*ws, *NEGATIONS})) for ws in _WORDS])

    def cast(chosen: Column) -> Column:
        """All votes of the places of the chosen words for candidates, by offset and place."""
        places = F.filter(F.transform(words, lambda w, i: F.struct(w.alias("w"), i.alias("i"))),
                          lambda x: F.array_contains(chosen, x["w"]))
        return F.sort_array(F.flatten(F.transform(places, lambda x: F.transform(
            F.filter(index[x["w"]], lambda q: F.array_contains(candidates, q["t"])),
            lambda q: F.struct(q["t"].alias("t"), (x["i"] - q["p"]).alias("off"), q["p"].alias("p"),
                               q["rare"].alias("rare"), q["key"].alias("key"))))))

    zero = F.struct(F.lit(-1).alias("t"), F.lit(0).alias("off"), F.lit(0).alias("n"), F.lit(0).alias("rare"),
                    F.lit(0).alias("key"), F.lit(False).alias("denied"), F.lit(0).alias("most"), F.array().cast(_VOTE).alias("out"))

    def closed(acc: Column) -> Column:
        run = F.struct(acc["t"].alias("t"), acc["most"].alias("n"))
        return F.when(acc["most"] > 0, F.concat(acc["out"], F.array(run))).otherwise(acc["out"])

    def step(acc: Column, x: Column) -> Column:
        ours = x["t"] == acc["t"]
        same = ours & (x["off"] == acc["off"])
        before = lambda name: F.when(same, acc[name]).otherwise(0)
        # a place holds one word, so each vote at an offset is another place of the template
        now = F.struct((before("n") + (x["p"] >= 0).cast("int")).alias("n"), (before("rare") + x["rare"]).alias("rare"),
                       (before("key") + x["key"]).alias("key"), F.when(same, acc["denied"]).otherwise(x["p"] < 0).alias("denied"))

        def after(f: Column) -> Column:
            need = F.get(needed, x["t"])
            passes = ~f["denied"] & (f["n"] >= need["n"]) & (f["rare"] >= need["rare"]) & (f["key"] >= need["key"])
            return F.struct(x["t"].alias("t"), x["off"].alias("off"), f["n"].alias("n"), f["rare"].alias("rare"),
                            f["key"].alias("key"), f["denied"].alias("denied"),
                            F.greatest(F.when(ours, acc["most"]).otherwise(0), F.when(passes, f["n"]).otherwise(0)).alias("most"),
                            F.when(ours, acc["out"]).otherwise(closed(acc)).alias("out"))

        return let(now, after)

    chosen = F.array_distinct(F.flatten(F.transform(candidates, lambda t: F.get(of_template, t))))
    return F.when(F.size(candidates) > 0, let(chosen, lambda c: F.aggregate(cast(c), zero, step, closed))).otherwise(
        F.array().cast(_VOTE))


def _of(template: int):
    return lambda vote: vote["t"] == template


def scan(docs: DataFrame) -> DataFrame:
    """One row per document: word count, places and labels of licenses, score."""
    total, counts = document_counts(docs)
    rarest = signatures(total, counts)
    looked_up = sorted({w for ws in rarest for w in ws})

    rows = docs.select("doc_id", normal(text_of("text")).alias("norm"))
    rows = rows.select("doc_id", "norm", F.concat(F.lit(" "), "norm", F.lit(" ")).alias("pad"))
    rows = rows.withColumn("held", let(F.array_intersect(_strings(looked_up), F.split("norm", " ")),
                                       lambda found: _candidates(found, rarest)))
    rows = rows.withColumn("votes", _votes(F.split("norm", " "), F.col("held"), rarest))
    pad, norm = F.col("pad"), F.col("norm")
    n_words = F.when(norm == "", F.lit(0)).otherwise(_spaces(norm) + 1).cast("long")

    places, firsts, lasts, base = [], [], [], []
    for phrase, label in BASE:
        has = _contains(pad, phrase)
        places.append(F.when(has, F.regexp_count(pad, F.lit(f" {phrase}(?= )"))).otherwise(0))
        firsts.append(F.when(has, _spaces(F.substring_index(pad, f" {phrase} ", 1))))
        lasts.append(F.when(has, n_words - len(phrase.split()) - _spaces(F.substring_index(pad, f" {phrase} ", -1))))
        base.append(F.when(has, F.lit(label)))
    verified, scores = [], [F.lit(0.0)]
    for t, (label, _, phrases) in enumerate(TEMPLATES):
        most = F.array_max(F.transform(F.filter("votes", _of(t)), lambda v: v["n"]))
        for phrase in phrases[1:] if len(_WORDS[t]) > SHORT else ():
            most = F.when(_contains(pad, phrase), most)
        verified.append(F.when(most.isNotNull(), F.lit(label)))
        scores.append(most / len(_WORDS[t]))
    joined = lambda cs: F.array_join(F.array_sort(F.array_distinct(F.array_compact(F.array(*cs)))), ",")
    any_votes = F.coalesce(*verified).isNotNull()
    some = F.coalesce(*base).isNotNull()
    return rows.select(
        "doc_id", n_words.alias("n_words"), sum(places[1:], places[0]).cast("long").alias("n_base"),
        F.least(*firsts).alias("first_word"), F.greatest(*lasts).alias("last_word"),
        joined(base).alias("base_labels"),
        F.when(F.size("votes") > 0, joined(base + verified)).otherwise(joined(base)).alias("labels"),
        F.when(some, F.lit(1.0)).when(any_votes, F.greatest(*scores)).otherwise(0.0).alias("score"))
