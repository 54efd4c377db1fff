"""Quality rules as weak supervision.

Each rule votes bad (0), good (1) or abstains (-). A model with one class of good
documents and one kind of bad ones a rule is fitted by expectation-maximisation on
the counts of vote patterns, and a document is kept when the posterior probability
of the good class reaches one half. One bad vote rejects a document as long as its
rule is trusted; a rule that blames more than about a fifth of the corpus with no
other rule on its side is found unreliable, and its bad vote alone rejects nothing.
The fit needs no labels. Only the pattern counts reach the driver: at most 3^8 rows
whatever the corpus size.

Nulls and odd rows: a null text counts as empty; an empty text has no words and
fails the base rules; a null doc_id is carried through; every input row gives
one output row, repeated rows included; other columns are ignored, whatever
their names; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from studylake.llm import words as W
from studylake.llm.common import fresh, staged

WINDOW = 5
#: The variety rule's share of distinct words is taken in spans of so many words.
SPAN = 2000
#: Prior means: part of the documents that is bad, shared by the kinds; chance that a
#: rule blames its own kind, another kind, a good document.
P_BAD, FOUND, ALSO_FOUND, FALSE_BLAME = 0.2, 0.9, 0.1, 0.002
#: Weights of these priors, in corpora; with them a rule that alone blames more than
#: about a fifth of the corpus is distrusted.
CLASS_WEIGHT, FOUND_WEIGHT, BLAME_WEIGHT, WEAK, SILENT_WEIGHT = 2.0, 0.1, 1.0, 0.01, 0.2
RULES = ("length", "symbols", "repeats", "lines", "capitals", "shouting", "word_length", "variety")

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_FIRST = np.array([(b & 0xC0) != 0x80 for b in range(256)]) & ~W.IS_SPACE
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = _UPPER.copy()
_LETTER[97:123] = True
_SHOUT = np.zeros(256, bool)
_SHOUT[33] = True

_TYPE = T.StructType(
    [T.StructField(n, T.LongType()) for n in
     ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    + [T.StructField("votes", T.StringType())])


def _per_doc(block: W.Block, table: np.ndarray) -> np.ndarray:
    return np.array([np.count_nonzero(table[np.frombuffer(x, np.uint8)]) for x in block.data], np.int64)


def _repeated(block: W.Block) -> np.ndarray:
    """Words of each document that lie in a window found twice or more in it."""
    h, doc = W.windows(block, WINDOW)
    covered = np.zeros(len(block.hashes) + 1, np.int64)
    ok = np.flatnonzero(doc >= 0)
    if len(ok):
        key = h[ok] ^ W.mix(doc[ok].astype(np.uint64) + np.uint64(1))
        order = np.argsort(key)
        same = key[order][1:] == key[order][:-1]
        twice = np.zeros(len(ok), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        at = ok[twice]
        np.add.at(covered, at, 1)
        np.subtract.at(covered, at + WINDOW, 1)
    inside = np.cumsum(covered[:-1]) > 0
    return np.bincount(block.doc[inside], minlength=block.n_docs)


def _variety(block: W.Block) -> np.ndarray:
    """Share of distinct words in spans of SPAN words, mean over a text's spans;
    the last one ends with the text, and a shorter text is one span."""
    n = block.n_words
    at = np.arange(len(block.doc)) - (np.cumsum(n) - n)[block.doc]
    own, whole = n[block.doc], (n // SPAN)[block.doc]
    aligned = (own < SPAN) | (at < whole * SPAN)
    last = (own > SPAN) & (own % SPAN > 0) & (at >= own - SPAN)
    doc = np.concatenate([block.doc[aligned], block.doc[last]])
    span = np.concatenate([at[aligned] // SPAN, whole[last]]).astype(np.uint64)
    word = np.concatenate([block.hashes[aligned], block.hashes[last]])
    kinds = np.unique(word ^ W.mix((doc.astype(np.uint64) << np.uint64(32)) + span + np.uint64(7)), return_index=True)[1]
    distinct = np.bincount(doc[kinds], minlength=block.n_docs)
    return distinct / np.maximum(np.where(n < SPAN, n, -(-n // SPAN) * SPAN), 1)


def _lines(text: str) -> tuple[int, int]:
    """Lines with a word, and those equal to an earlier one."""
    found = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    return len(found), len(found) - len(set(found))


def _vote(bad: np.ndarray, good: np.ndarray) -> np.ndarray:
    return np.where(bad, "0", np.where(good, "1", "-"))


def measure(texts: pd.Series) -> pd.DataFrame:
    """Base counts and rule votes of a batch of texts."""
    texts = texts.fillna("")
    out = []
    for block in W.blocks([t.encode("utf-8", "surrogatepass") for t in texts]):
        own = texts.iloc[block.first:block.first + block.n_docs]
        n = block.n_words
        at_least = np.maximum(n, 1)
        chars, symbols = _per_doc(block, _FIRST), _per_doc(block, _SYMBOL)
        letters, upper, shouts = (_per_doc(block, t) for t in (_LETTER, _UPPER, _SHOUT))
        repeats = _repeated(block)
        lines = np.array([_lines(t) for t in own], np.int64).reshape(-1, 2)
        variety = _variety(block)
        per_word, mean = symbols / at_least, chars / at_least
        caps = upper / np.maximum(letters, 1)
        dup = lines[:, 1] / np.maximum(lines[:, 0], 1)
        votes = [
            _vote(n < 10, n >= 50),
            _vote(per_word > 0.1, per_word < 0.03),
            _vote(100 * repeats > 20 * n, 100 * repeats < 10 * n),
            _vote((dup > 0.5) & (lines[:, 0] >= 4), dup < 0.15),
            _vote((caps > 0.5) & (letters >= 20), caps < 0.2),
            _vote(shouts / at_least > 0.1, shouts / at_least < 0.02),
            _vote((mean < 2) | (mean > 15), (mean >= 2.5) & (mean <= 11)),
            _vote((variety < 0.08) & (n >= 40), variety > 0.2),
        ]
        frame = pd.DataFrame({"n_words": n, "word_chars": chars, "n_symbols": symbols,
                              "n_dup_lines": lines[:, 1], "n_repeat_words": repeats})
        frame["votes"] = ["".join(v) for v in zip(*votes, strict=True)]
        out.append(frame)
    if not out:
        return pd.DataFrame({f.name: pd.Series(dtype="object" if f.name == "votes" else "int64")
                             for f in _TYPE.fields})
    return pd.concat(out, ignore_index=True)


@F.pandas_udf(_TYPE)
def _measured(texts: pd.Series) -> pd.DataFrame:
    return measure(texts)


def _em(n: np.ndarray, v: np.ndarray, false_blame: np.ndarray, rounds: int) -> tuple[np.ndarray, float]:
    """Expectation-maximisation from the given chances that a rule blames a good
    document: the good class's probability of each pattern, and the log posterior.

    Bad documents come in unlike kinds, one a rule, which that rule mostly finds
    and the others sometimes. A vote is drawn in two steps, bad or not, then good
    or abstaining. Every chance has a Beta prior (the classes a Dirichlet prior)
    that weighs a constant times the corpus, so a corpus and ten copies of it
    give the same answer."""
    rules, total = v.shape[1], n.sum()
    expect = np.vstack([np.full(rules, FALSE_BLAME), np.where(np.eye(rules, dtype=bool), FOUND, ALSO_FOUND)])
    weigh = np.vstack([np.full(rules, BLAME_WEIGHT), np.where(np.eye(rules, dtype=bool), FOUND_WEIGHT, WEAK)]) * total
    share = np.r_[1 - P_BAD, np.full(rules, P_BAD / rules)]
    is_bad, is_silent = (v == 0).T, (v == 2).T
    # abstaining says little by itself: each class starts from the corpus's share
    quiet = np.tile((is_silent @ n + 1) / (~is_bad @ n + 2), (rules + 1, 1))
    hush = SILENT_WEIGHT * total
    blamed, classes, silent = expect.copy(), share.copy(), quiet.copy()
    blamed[0] = false_blame

    def per_pattern() -> np.ndarray:
        other = np.where(is_silent, np.log(silent)[:, :, None], np.log1p(-silent)[:, :, None])
        vote = np.where(is_bad, np.log(blamed)[:, :, None], np.log1p(-blamed)[:, :, None] + other)
        return np.log(classes)[:, None] + vote.sum(1)

    def posteriors(log: np.ndarray) -> np.ndarray:
        out = np.exp(log - log.max(0))
        return out / out.sum(0)

    for _ in range(rounds):
        weight = posteriors(per_pattern()) * n
        each = weight.sum(1)
        bad, none = weight @ is_bad.T, weight @ is_silent.T
        classes = (each + CLASS_WEIGHT * total * share) / (total * (1 + CLASS_WEIGHT))
        blamed = (bad + weigh * expect) / (each[:, None] + weigh)
        silent = (none + hush * quiet) / (each[:, None] - bad + hush)
    log = per_pattern()
    top = log.max(0)
    goal = (n * (top + np.log(np.exp(log - top).sum(0)))).sum()
    goal += (weigh * (expect * np.log(blamed) + (1 - expect) * np.log1p(-blamed))).sum()
    goal += hush * (quiet * np.log(silent) + (1 - quiet) * np.log1p(-silent)).sum()
    goal += CLASS_WEIGHT * total * (share * np.log(classes)).sum()
    return posteriors(log)[0], float(goal)


def fit(patterns: dict[str, int], rounds: int = 60) -> dict[str, float]:
    """Posterior probability of the good class for each vote pattern.

    The estimated rates have priors, not bounds. The first fit trusts every
    rule. Then one rule at a time is distrusted, that is, expectation-maximisation
    begins with a chance of false blame equal to its share of bad votes; the
    distrust that raises the log posterior most stays, until none raises it.
    So a rule that blames a large part of the corpus, with no other rule on its
    side, loses its say, and one that blames few documents keeps it."""
    if not patterns:
        return {}
    keys = sorted(patterns)
    n = np.array([patterns[k] for k in keys], float)
    v = np.array([[{"0": 0, "1": 1, "-": 2}[c] for c in k] for k in keys])
    share = np.clip((n[:, None] * (v == 0)).sum(0) / n.sum(), FALSE_BLAME, 1 - FALSE_BLAME)

    def start(distrusted: frozenset[int]) -> np.ndarray:
        return np.array([share[r] if r in distrusted else FALSE_BLAME for r in range(len(share))])

    chosen: frozenset[int] = frozenset()
    good, best = _em(n, v, start(chosen), rounds)
    while True:
        tries = [chosen | {r} for r in range(len(share)) if r not in chosen and share[r] > FALSE_BLAME]
        found = [(*_em(n, v, start(c), rounds), c) for c in tries]
        found = [f for f in found if f[1] > best + 1e-6 * n.sum()]
        if not found:
            return dict(zip(keys, good.tolist(), strict=True))
        good, best, chosen = max(found, key=lambda f: f[1])


def posterior(measured: DataFrame, votes: str) -> dict[str, float]:
    """Fit on the vote patterns of all rows (one aggregation; at most 3^8 patterns)."""
    rows = measured.groupBy(F.col(votes).alias("votes")).count().collect()
    return fit({r["votes"]: r["count"] for r in rows})


def _lookup(votes: Column, table: dict[str, float]) -> Column:
    if not table:
        return F.lit(None).cast("double")
    flat = [F.lit(x) for kv in table.items() for x in kv]
    return F.element_at(F.create_map(*flat), votes)


def _base_failed(m: Column) -> Column:
    return (m["n_words"] < 10) | (100 * m["n_repeat_words"] > 20 * m["n_words"])


def judge(docs: DataFrame) -> DataFrame:
    """One row per document: base counts, base_failed, p_good and kept."""
    # texts are measured once; the measures are small
    m = staged(docs.select("doc_id", _measured("text").alias("m")), "rule-measures")
    p = _lookup(F.col("m.votes"), posterior(m.select(F.col("m.votes").alias("votes")), "votes"))
    failed = _base_failed(F.col("m"))
    return m.select(
        "doc_id", *[F.col(f"m.{f.name}").alias(f.name) for f in _TYPE.fields if f.name != "votes"],
        failed.alias("base_failed"), (~failed & (p >= 0.5)).alias("kept"),
        p.alias("p_good"), F.col("m.votes").alias("votes"))


def keep(docs: DataFrame) -> DataFrame:
    """The rows that pass, with all their columns."""
    name = fresh("rules")
    m = docs.withColumn(name, _measured("text"))
    p = posterior(docs.select(_measured("text").alias("m")).select(F.col("m.votes").alias("votes")), "votes")
    col = F.col(name)
    return m.filter(~_base_failed(col) & (_lookup(col["votes"], p) >= 0.5)).select(*docs.columns)
