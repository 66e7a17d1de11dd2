"""Secrets in texts: named patterns, and tokens that pass a battery of randomness tests.

Candidates are runs of 20 or more characters of the usual encodings. The encoding is inferred from a token's
characters (hexadecimal, base 32, letters and digits, base 64), and with it the alphabet of its tests:

* chi-squared for a uniform use of the alphabet,
* Wald and Wolfowitz' runs test around the middle of the alphabet,
* serial correlation of neighbouring characters.

A token that fails one of them is not random. The chi-squared value also gives the probability ``p`` that
*text* of this length looks so uniform: text uses its letters unevenly, which adds to the statistic in
proportion to length, so short tokens are weak evidence and long ones strong. Over all candidates of the
corpus, Benjamini and Hochberg's rule bounds the share of false discoveries, separately for each encoding
and length band, from counts of ``-log10 p`` in steps of 1/20.

Only built-in expressions are used. NULL text is an empty one; rows may repeat.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripstrata.llm.private import free_name

# The patterns of the named kinds and the order in which kinds are listed.
ASSIGN = (
    r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"  # as runs of any length of which the shorter are dropped
KINDS = ("assign", "access", "hex", "random")

_LOWER, _UPPER, _DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
ENCODINGS = (
    ("hex", r"^([0-9a-f]+|[0-9A-F]+)$", _DIGITS + "abcdef"),
    ("base32", r"^[A-Z2-7]+=*$", _UPPER + "234567"),
    ("base62", r"^[A-Za-z0-9]+$", _UPPER + _LOWER + _DIGITS),
    ("base64", r"", _UPPER + _LOWER + _DIGITS + "+/"),
)
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
#: Sum of squared letter shares of running text, against 1/size for a uniform use.
TEXT_CONCENTRATION = {"hex": 0.1, "base32": 0.065, "base62": 0.065, "base64": 0.065}
FALSE_SHARE = 0.01
REJECT_Z = 3.5
STEPS, MOST = 20, 180
BANDS = (24, 32, 48, 64, 128, 512)


def _let(value: Column, use) -> Column:
    """``use`` of a value that is worked out once, also inside of functions of array elements."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _spans(text: Column, pattern: str, kind: int, keep) -> Column:
    """Structs (start, kind, end, token) of the matches that ``keep`` holds for.

    The text between matches, from splitting at them, gives their places.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    empty = F.array().cast("array<struct<start:long,kind:int,end:long,token:string>>")
    start = F.struct(F.lit(0).cast("long").alias("at"), empty.alias("spans"))

    def step(state, pair):
        begin = state["at"] + F.length(pair["gap"])
        end = begin + F.length(pair["token"])
        span = F.struct(
            begin.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), pair["token"].alias("token")
        )
        return F.struct(
            end.alias("at"),
            F.when(keep(pair["token"]), F.array_append(state["spans"], span))
            .otherwise(state["spans"])
            .alias("spans"),
        )

    pairs = F.zip_with(
        F.slice(between, 1, F.size(found)),
        found,
        lambda gap, token: F.struct(gap.alias("gap"), token.alias("token")),
    )
    return F.when(text.rlike(pattern), F.aggregate(pairs, start, step, lambda s: s["spans"])).otherwise(
        empty
    )


def _by_encoding(token: Column, value) -> Column:
    """The value for the first encoding that fits; all are constants of the plan."""
    *first, last = ENCODINGS
    out = None
    for name, pattern, alphabet in first:
        out = (F if out is None else out).when(token.rlike(pattern), value(name, alphabet))
    return out.otherwise(value(last[0], last[2]))


def _body(token: Column) -> Column:
    """The token in its alphabet's letters: one case for hexadecimal, no padding or separators."""
    lower = F.when(token.rlike(ENCODINGS[0][1]), F.lower(token)).otherwise(token)
    return F.regexp_replace(F.translate(lower, "-_", "+/"), "=", "")


def chi_squared(body: Column, size: Column) -> Column:
    squares = F.aggregate(
        F.array_distinct(F.split(body, "")),
        F.lit(0.0),
        lambda total, c: total
        + F.pow(F.length(body) - F.length(F.replace(body, c, F.lit(""))), F.lit(2)).cast("double"),
    )
    return squares * size / F.length(body) - F.length(body)


def runs_z(bits: Column) -> Column:
    n = F.length(bits).cast("double")
    ones = F.length(F.replace(bits, F.lit("0"), F.lit(""))).cast("double")
    both = 2.0 * ones * (n - ones)
    runs = F.length(F.regexp_replace(bits, "0+|1+", "r"))
    variance = both * (both - n) / (n * n * (n - 1.0))
    return F.when(variance > 0, (runs - 1.0 - both / n) / F.sqrt(variance)).otherwise(F.sqrt(n))


def serial_z(places: Column) -> Column:
    n = F.size(places)
    mean = F.aggregate(places, F.lit(0.0), lambda a, x: a + x) / n

    def correlation(apart):
        squares = F.aggregate(apart, F.lit(0.0), lambda a, x: a + x * x)
        products = F.aggregate(
            F.zip_with(F.slice(apart, 1, n - 1), F.slice(apart, 2, n - 1), lambda x, y: x * y),
            F.lit(0.0),
            lambda a, x: a + x,
        )
        return F.when(squares > 0, products / squares * F.sqrt(n)).otherwise(F.sqrt(n))

    return _let(mean, lambda m: _let(F.transform(places, lambda x: x - m), correlation))


def normal_below(z: Column) -> Column:
    """The normal distribution function (rational approximation of the error function)."""
    x = F.abs(z) / 2**0.5
    t = 1 / (1 + 0.3275911 * x)
    tail = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    half = tail * F.exp(-x * x) / 2
    return F.when(z < 0, half).otherwise(1 - half)


def _tested(token: Column) -> Column:
    """(stratum, level, random) of a candidate; level is ``-log10 p`` in steps of 1/20."""
    return _let(_body(token), lambda body: _let(_size(token), lambda size: _battery(token, body, size)))


def _size(token: Column) -> Column:
    return _by_encoding(token, lambda _, alphabet: F.lit(len(alphabet)))


def _battery(token: Column, body: Column, size: Column) -> Column:
    n = F.length(body)
    extra = _by_encoding(
        token, lambda name, alphabet: F.lit(len(alphabet) * TEXT_CONCENTRATION[name] - 1)
    )
    bits = _by_encoding(
        token,
        lambda _, alphabet: F.translate(
            body, alphabet, "0" * (len(alphabet) // 2) + "1" * (len(alphabet) - len(alphabet) // 2)
        ),
    )
    places = _by_encoding(
        token, lambda _, alphabet: F.transform(F.split(body, ""), lambda c: F.instr(F.lit(alphabet), c))
    )
    band = sum((F.when(n >= b, 1).otherwise(0) for b in BANDS), F.lit(0))
    code = _by_encoding(token, lambda name, _: F.lit([e[0] for e in ENCODINGS].index(name)))

    def verdict(chi):
        z_text = (chi - (size - 1 + n * extra)) / F.sqrt(2.0 * (size - 1) + 4.0 * n * extra)
        below = F.greatest(_let(z_text, normal_below), F.lit(1e-12))
        level = F.least(F.lit(MOST), F.floor(-STEPS * F.log10(below)))
        uniform = (chi - (size - 1)) / F.sqrt(2.0 * (size - 1)) < REJECT_Z
        even = (F.abs(_let(bits, runs_z)) < REJECT_Z) & (F.abs(_let(places, serial_z)) < REJECT_Z)
        return F.struct(
            (code * 10 + band).alias("stratum"), level.cast("int").alias("level"), (even & uniform).alias("random")
        )

    return F.when(n >= 16, _let(chi_squared(body, size), verdict))


def _thresholds(texts: DataFrame, text: Column) -> dict[int, int]:
    """The least level of a discovery in each stratum; at most 40 of them."""
    levels = (
        texts.select(F.explode(F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0))).alias("token"))
        .select(_tested(F.col("token")).alias("t"))
        .where("t IS NOT NULL")
        .groupBy("t.stratum", "t.level")
        .agg(F.count(F.lit(1)).alias("n"))
        .collect()
    )
    counts: dict[int, dict[int, int]] = {}
    for stratum, level, n in levels:
        counts.setdefault(stratum, {})[level] = n
    out = {}
    for stratum, by_level in counts.items():
        everything, above = sum(by_level.values()), 0
        for level in sorted(by_level, reverse=True):
            above += by_level[level]
            if 10 ** (-level / STEPS) * everything <= FALSE_SHARE * above:
                out[stratum] = level
    return out


def _listed(spans: Column) -> Column:
    name = F.array(*map(F.lit, KINDS))
    return F.concat_ws(
        ",",
        F.transform(
            spans,
            lambda s: F.concat_ws(":", F.element_at(name, s["kind"]), s["start"].cast("string"), s["end"].cast("string")),
        ),
    )


def find_secrets(docs: DataFrame, text: str = "text") -> DataFrame:
    """All columns of ``docs`` with ``secret_spans`` (start, kind, end, token), sorted, added.

    ``kind`` counts ``KINDS`` from 1. Spans of different named kinds may overlap; random tokens that overlap
    a named span are not listed again.
    """
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    least = _thresholds(docs.select(text), whole)
    assign = _spans(whole, ASSIGN, 1, lambda t: F.length(F.regexp_extract(t, ASSIGN, 2)) >= 6)
    access = _spans(whole, ACCESS, 2, lambda t: F.length(t) >= 20)
    hexes = _spans(whole, HEX, 3, lambda t: F.length(t) >= 24)
    own = free_name(docs, "named_spans")
    named = docs.withColumn(own, F.concat(assign, access, hexes))
    if least:
        level = F.create_map(*[F.lit(x) for pair in least.items() for x in pair])

        def discovered(token):
            return _let(
                _tested(token),
                lambda t: F.coalesce((t["level"] >= level[t["stratum"]]) & t["random"], F.lit(False)),
            )

        random = F.filter(
            _spans(whole, CANDIDATE, 4, discovered),
            lambda s: ~F.exists(own, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])),
        )
        spans = F.concat(own, random)
    else:
        spans = F.col(own)
    return named.withColumn("secret_spans", F.array_sort(spans)).drop(own)


def secret_digests(docs: DataFrame) -> DataFrame:
    """The counts and digests of each document's spans."""
    found = find_secrets(docs.select("doc_id", "text"))
    spans = F.col("secret_spans")
    base = F.filter(spans, lambda s: s["kind"] < 4)

    def count(kind: int) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        count(1).alias("n_assign"),
        count(2).alias("n_access"),
        count(3).alias("n_hex"),
        F.sha2(_listed(base), 256).alias("base_sha256"),
        _listed(spans).alias("spans"),
        count(4).alias("n_random"),
    )


def redact(docs: DataFrame, mark: str = "[SECRET]", text: str = "text") -> DataFrame:
    """The documents with every span of a secret replaced by a mark."""
    found = find_secrets(docs)
    whole = F.col(text).cast("string")
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("done"))

    def step(state, span):
        gap = F.substring(whole, (state["at"] + 1).cast("int"), (span["start"] - state["at"]).cast("int"))
        return F.when(
            span["start"] >= state["at"],
            F.struct(span["end"].alias("at"), F.concat(state["done"], gap, F.lit(mark)).alias("done")),
        ).otherwise(F.struct(F.greatest(span["end"], state["at"]).alias("at"), state["done"].alias("done")))

    rest = F.aggregate(
        F.col("secret_spans"),
        start,
        step,
        lambda s: F.concat(s["done"], F.substring(whole, (s["at"] + 1).cast("int"), F.lit(2**31 - 1))),
    )
    clean = F.when(F.size("secret_spans") > 0, rest).otherwise(whole)
    return found.withColumn(text, clean).drop("secret_spans")
