"""Secret scans: fixed patterns plus a battery of randomness tests, with
DataFrame functions only.

Patterns give the base spans. The battery looks at every run of 20 or more
token characters, whatever they are: it infers the encoding (hexadecimal, base
32, letters, letters and digits, base 64; capitals count as small letters where a
run has one case only) and asks three questions of the run's symbols:

* chi-squared: are they as even over the encoding's alphabet as random ones, or
  as uneven as words are? It is asked of all symbols, and of the alphabet pooled
  into two cells, the symbols that words use often and those that they seldom
  use. The p-value is the chance that word-like symbols of this length come out
  as even as these in both.
* runs: does the sequence cross the middle of the alphabet as often as a random one?
* serial correlation: do neighbouring symbols depend on each other?

A run is reported if neither of the last two rejects randomness and the first
is a discovery at FDR 1 %: within its class of length, the Benjamini-Hochberg
bound over the p-values of all candidates of the corpus. The bound comes from a
histogram of p-values (at most 400 cells a class), so no ranking of all
candidates is needed. Runs of decimal digits are numbers, not hexadecimal.
Short runs of one case's letters differ least from words: among as many words,
three in ten of 20 letters are found, three in ten to two in three of 24, seven in
ten of 32, nine in ten of 64; of the other encodings, two in three or more of 24
symbols, nine in ten or more from 32 on.

Nulls and odd rows: a null text counts as empty and has no spans; a null doc_id
is carried through; each input row gives one output row, repeated rows
included; other columns are ignored, whatever their names; an empty table gives
an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from studylake.llm.common import fresh, let, staged, text_of

# Fixed values of the base patterns.
ASSIGN = (r"""(?i:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))""")
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 8, 16, 32
KINDS = ("assign", "access", "hex", "random")

MIN_RUN = 20
FDR = 0.01
#: A test rejects randomness beyond this many standard deviations.
REJECT = 3.3
#: Cells of the histogram: -log10 p in steps of 0.1 up to 40.
STEP, CELLS = 0.1, 400
_LOW, _DIGITS, _SIGNS = "abcdefghijklmnopqrstuvwxyz", "0123456789", "+/-_="
#: Letters that words seldom use: all but the twelve most frequent of English.
_SELDOM = "bcfgjkmpqvwxyz"
#: Encodings in the order in which they are tried: pattern, symbols, how unevenly
#: words use them, as the sum over symbols of (p - 1/k)^2 * k, the symbols that
#: words seldom use, and these symbols' part of word-like runs at most.
ENCODINGS = (
    ("hex", r"[0-9a-f]+", _DIGITS + "abcdef", 0.9, "abcdef", 0.1),
    ("letters", r"[a-z]+", _LOW, 0.7, _SELDOM, 0.25),
    ("base32", r"[a-z2-7=]+", _LOW + "234567", 1.1, _SELDOM + "234567", 0.25),
    ("digits and letters", r"[a-z0-9]+", _LOW + _DIGITS, 1.0, _SELDOM + _DIGITS, 0.3),
    ("one case", r"[a-z0-9+/_=-]+", _LOW + _DIGITS + _SIGNS, 1.5, _SELDOM + _DIGITS, 0.3),
    ("mixed letters", r"[A-Za-z]+", _LOW.upper() + _LOW, 1.5, _LOW.upper() + _SELDOM, 0.4),
    ("alnum", r"[A-Za-z0-9]+", _DIGITS + _LOW.upper() + _LOW, 2.0, _LOW.upper() + _DIGITS + _SELDOM, 0.4),
    ("base64", r".*", _LOW.upper() + _LOW + _DIGITS + _SIGNS, 2.5, _LOW.upper() + _DIGITS + _SELDOM, 0.4),
)
#: Correlation of the two parts of the chi-squared test in word-like runs.
TOGETHER = 0.5

_SPAN = "array<struct<kind:int,start:int,stop:int,text:string>>"


def _matches(text: Column, pattern: str, kind: int, group: int | None, least: int, guard: Column) -> Column:
    """All leftmost matches with their place, those that are too short dropped.

    The pieces between matches and the matches themselves, laid end to end,
    give each match's place in characters."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = F.split(text, pattern, -1)
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    zero = F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("out"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["part"])
        stop = start + F.length(x["hit"])
        span = F.struct(F.lit(kind).alias("kind"), start.alias("start"), stop.alias("stop"), x["value"].alias("text"))
        keep = x["hit"].isNotNull() & (F.length(x["value"]) >= least)
        return F.struct(F.coalesce(stop, start).alias("at"),
                        F.when(keep, F.concat(acc["out"], F.array(span))).otherwise(acc["out"]).alias("out"))

    zipped = F.arrays_zip(parts.alias("part"), found.alias("hit"), value.alias("value"))
    return F.when(guard, F.aggregate(zipped, zero, step, lambda a: a["out"])).otherwise(F.array().cast(_SPAN))


def _base(text: Column) -> Column:
    return F.concat(
        _matches(text, ASSIGN, 0, 2, MIN_ASSIGN, text.rlike(r"(?i:passw|secret|token|api_?key)")),
        _matches(text, ACCESS, 1, None, MIN_ACCESS, F.contains(text, F.lit("AKIA"))),
        _matches(text, r"[0-9a-f]{%d,}" % MIN_HEX, 2, None, MIN_HEX, text.rlike(r"[0-9a-f]{%d}" % MIN_HEX)))


def _candidates(text: Column) -> Column:
    return _matches(text, r"[A-Za-z0-9+/_=-]{%d,}" % MIN_RUN, 3, None, MIN_RUN, text.rlike(r"[A-Za-z0-9+/_=-]{%d}" % MIN_RUN))


def _tail(z: Column) -> Column:
    """-log10 of the lower tail of a normal, by the usual expansion; 0 above the mean."""
    z = F.greatest(-z, F.lit(0.0))
    # Mills-ratio bounds keep this within a few percent, at any distance
    t = 1.0 / (1.0 + 0.2316419 * z)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    return (z * z / 2.0 + 0.9189385332046727 - F.log(poly)) / 2.302585092994046


def _tested(span: Column) -> Column:
    """The span with the cell of -log10 p, 0 where randomness does not hold, and its length class."""
    t = span["text"]
    known = F.array(*[F.struct(F.lit(s).alias("symbols"), F.lit(float(len(s))).alias("k"), F.lit(d).alias("skew"),
                               F.lit(o).alias("seldom"), F.lit(len(o) / len(s)).alias("even"), F.lit(q).alias("words"))
                      for _, _, s, d, o, q in ENCODINGS])

    def encoding(text: Column) -> Column:
        which = F.lit(len(ENCODINGS) - 1)
        for i, (_, pattern, *_) in reversed(list(enumerate(ENCODINGS[:-1]))):
            which = F.when(text.rlike(f"^{pattern}$"), F.lit(i)).otherwise(which)
        return F.get(known, which)

    # every value that an inner function uses is bound first, so that it is computed once
    folded = F.when(t.rlike("[a-z]") & t.rlike("[A-Z]"), t).otherwise(F.lower(t))
    facts = let(folded, lambda x: let(encoding(x), lambda e: F.struct(
        x.alias("text"), F.length(x).cast("double").alias("n"), e.alias("e"))))

    def evenness(b: Column) -> Column:
        n, e = b["n"], b["e"]
        k, words = e["k"], e["words"]
        # seldom used symbols, beyond the part that an even run has of them, say nothing more
        seldom = F.least(n - F.length(F.call_function("translate", b["text"], e["seldom"], F.lit(""))), n * e["even"])
        pooled = (seldom - n * words) / F.sqrt(n * words * (1 - words))

        def of(chars: Column) -> Column:
            squares = F.aggregate(F.array_distinct(chars), F.lit(0.0),
                                  lambda a, c: a + F.pow(n - F.length(F.replace(b["text"], c, F.lit(""))), F.lit(2)))
            chi = squares * k / n - n
            # of word-like symbols: non-central, mean k - 1 + n d, variance 2 (k - 1 + 2 n d)
            even = (chi - (k - 1 + n * e["skew"])) / F.sqrt(2 * (k - 1 + 2 * n * e["skew"]))
            holds = let(F.transform(chars, lambda c: F.instr(e["symbols"], c).cast("double")), lambda value: let(
                F.aggregate(value, F.lit(0.0), lambda a, v: a + v) / n, lambda mean: _steady(value, mean, n)))
            return F.when(holds, let((even - pooled) / (2 + 2 * TOGETHER) ** 0.5, _tail)).otherwise(F.lit(0.0))

        return let(F.split(b["text"], ""), of)

    p = let(facts, evenness)
    return F.struct(span["start"].alias("start"), span["stop"].alias("stop"),
                    F.least(F.floor(p / STEP), F.lit(CELLS - 1)).cast("int").alias("cell"),
                    F.least(F.floor(F.log2(F.length(t) / MIN_RUN)), F.lit(5)).cast("int").alias("class"))


def _steady(value: Column, mean: Column, n: Column) -> Column:
    """Neither the serial-correlation test nor the runs test rejects randomness."""
    pairs = F.zip_with(F.slice(value, 1, F.size(value) - 1), F.slice(value, 2, F.size(value) - 1),
                       lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    spread = F.aggregate(value, F.lit(0.0), lambda a, v: a + (v - mean) * (v - mean))
    together = F.aggregate(pairs, F.lit(0.0), lambda a, p: a + (p["a"] - mean) * (p["b"] - mean))
    serial = together / F.greatest(spread, F.lit(1e-9)) * F.sqrt(n)
    above = F.aggregate(value, F.lit(0.0), lambda a, v: a + (v > mean).cast("double"))
    crossings = F.aggregate(pairs, F.lit(1.0), lambda a, p: a + ((p["a"] > mean) != (p["b"] > mean)).cast("double"))
    expected = 2 * above * (n - above) / n + 1
    runs = (crossings - expected) / F.sqrt(F.greatest((expected - 1) * (expected - 2) / (n - 1), F.lit(1e-9)))
    return (F.abs(serial) <= REJECT) & (F.abs(runs) <= REJECT)


def thresholds(spans: DataFrame) -> dict[int, int]:
    """The least significant p cell of each length class (Benjamini-Hochberg over the histogram)."""
    rows = spans.select(F.explode("runs").alias("r")).groupBy("r.class", "r.cell").count().collect()
    out = {}
    for c in {r["class"] for r in rows}:
        own = {r["cell"]: r["count"] for r in rows if r["class"] == c}
        total, found = sum(own.values()), 0
        for cell in sorted(own, reverse=True):
            found += own[cell]
            if cell and 10 ** -(cell * STEP) <= FDR * found / total:
                out[c] = cell
    return out


def _measured(text: Column) -> list[Column]:
    return [_base(text).alias("base"), F.transform(_candidates(text), _tested).alias("runs")]


def _random(base: Column, runs: Column, least: dict[int, int]) -> Column:
    """Discovered runs that no base span touches."""
    if not least:
        return F.array().cast("array<struct<kind:int,start:int,stop:int>>")

    def found(r: Column) -> Column:
        ok = F.lit(False)
        for c, cell in sorted(least.items()):
            ok = ok | ((r["class"] == c) & (r["cell"] >= cell))
        return ok & ~F.exists(base, lambda b: (b["start"] < r["stop"]) & (r["start"] < b["stop"]))

    return F.transform(F.filter(runs, found), lambda r: F.struct(F.lit(3).alias("kind"), r["start"].alias("start"), r["stop"].alias("stop")))


def _joined(spans: Column) -> Column:
    """kind:start:stop by start, then kind as listed."""
    order = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["stop"].alias("stop"))))
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(order, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["stop"].cast("string"))), ",")


def scan(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, base and random spans (kind, start, stop)."""
    # texts are read once; spans are small
    rows = staged(docs.select("doc_id", *_measured(text_of("text"))), "secret-spans")
    least = thresholds(rows)
    plain = F.transform("base", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["stop"].alias("stop")))
    return rows.select("doc_id", plain.alias("base"), _random(F.col("base"), F.col("runs"), least).alias("random"))


def report(docs: DataFrame) -> DataFrame:
    """Counts, digest and span lists of each document."""
    n = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return scan(docs).select(
        "doc_id", n(0).alias("n_assign"), n(1).alias("n_access"), n(2).alias("n_hex"),
        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(F.concat("base", "random")).alias("spans"))


def clean(docs: DataFrame) -> DataFrame:
    """The documents with every secret replaced by [SECRET]; all stay, with all
    their columns. Where there is a column n_chars, it follows the new text."""
    base, runs = fresh("base"), fresh("runs")
    own = docs.select(*_measured(text_of("text")))
    least = thresholds(own)
    rows = docs.withColumns({base: _base(text_of("text")), runs: F.transform(_candidates(text_of("text")), _tested)})
    spans = F.concat(F.transform(base, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["stop"].alias("stop"))),
                     _random(F.col(base), F.col(runs), least))
    order = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"))))
    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    text = F.col("text")

    def step(acc: Column, s: Column) -> Column:
        new = F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit("[SECRET]"))
        # a span that begins inside the one before only lengthens it
        return F.when(s["start"] >= acc["at"], F.struct(s["stop"].alias("at"), new.alias("out"))).otherwise(
            F.struct(F.greatest(acc["at"], s["stop"]).alias("at"), acc["out"].alias("out")))

    masked = F.aggregate(base, zero, step, lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.length(text))))
    found = rows.withColumn(base, order)
    out = found.withColumn("text", F.when(F.size(base) > 0, masked).otherwise(text))
    if dict(docs.dtypes).get("n_chars") in ("int", "bigint"):
        kind = dict(docs.dtypes)["n_chars"]
        out = out.withColumn("n_chars", F.when(F.size(base) > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)
