"""Secret scans in DataFrame functions only: three base patterns and a battery of randomness tests.

Base kinds (leftmost non-overlapping matches of each pattern, then those too short are dropped):
assign (name, separator, value of 6 or more), access (AKIA..., 20 or more), hex (24 or more).

The battery looks at every maximal run of 20 or more letters, digits and +/_- (with = at its end). The
encoding is inferred from the characters: hex, base32, base62 or base64. Three statistics under "drawn
uniformly from that alphabet" are computed: chi-squared of the letter counts (Wilson-Hilferty), the
number of runs above and below the middle of the alphabet, and the serial correlation of neighbours.
Their three tail probabilities are combined by Fisher's method into P, the chance that a string drawn
uniformly fits as badly as this one. The chance that n characters of prose look uniform falls as
exp(-n * GAP), with LETTERS_GAP for runs without a digit, whose alphabet prose shares. The run's p-value is
the ratio exp(-n * GAP) / P, at most 1: a bad fit costs as much evidence as it is unlikely, which a longer
run can make up for, and a run of which one test alone rejects uniformity at LEVEL / 3 has the p-value 1.
Benjamini-Hochberg at rate FDR over the runs of a document decides: the more runs, the longer and the
more even a run has to be. Spans of kind random that lie inside a base span are not added.

Positions are code points, ends exclusive. They come from the pieces between matches: split() and
regexp_extract_all() agree on the matches, so summed lengths give each start.

Null texts count as empty. Repeated rows give the same result each; an empty table gives an empty
result. Very long texts are scanned whole, in one row; lists of spans grow by copying, so the time for a
text has a part that grows with the square of its number of matches (not of its length). Only doc_id and text are read (redact keeps all columns).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The kinds in their listed order, with the patterns that are scanned for.
PATTERNS = {
    "assign": r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    # A run that is long enough matches from the same start as its one-or-more form does: every
    # shorter match ends where its run of letters ends, so requiring the length here drops the same ones.
    "access": r"AKIA[A-Z0-9]{16,}",
    "hex": r"[0-9a-f]{24,}",
    "random": r"[A-Za-z0-9+/_-]{20,}={0,2}",
}
KINDS = tuple(PATTERNS)
LEVEL, GAP, LETTERS_GAP, FDR = 0.01, 0.5, 0.1, 0.01
MARK = "[SECRET]"
# The alphabets of the encodings, in their standard order.
ALPHABETS = {
    "hex": "0123456789abcdef",
    "HEX": "0123456789ABCDEF",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base62": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/-_",
}


def _spans(text: str, kind: str) -> Column:
    """Array of (start, end, kind number, match) of all matches, given their texts in column _<kind>."""
    found = F.col(f"_{kind}")
    pieces = F.split(F.col(text), PATTERNS[kind], -1)
    number = KINDS.index(kind)
    empty = "cast(array() as array<struct<start:int,end:int,k:int,t:string>>)"
    walked = F.aggregate(
        F.arrays_zip(found.alias("m"), F.slice(pieces, 1, F.size(found)).alias("p")),
        F.struct(F.lit(0).alias("at"), F.expr(empty).alias("out")),
        lambda a, x: F.struct(
            (a["at"] + F.length(x["p"]) + F.length(x["m"])).alias("at"),
            F.concat(a["out"], F.array(F.struct((a["at"] + F.length(x["p"])).alias("start"), (a["at"] + F.length(x["p"]) + F.length(x["m"])).alias("end"), F.lit(number).alias("k"), x["m"].alias("t")))).alias("out"),
        ),
        lambda a: a["out"],
    )
    return F.when(F.size(found) > 0, walked).otherwise(F.expr(empty))


def _choose() -> str:
    return "CASE " + " ".join(f"WHEN core RLIKE '^[{c}]+$' THEN '{ALPHABETS[n]}'" for n, c in (("hex", "0-9a-f"), ("HEX", "0-9A-F"), ("base32", "A-Z2-7"), ("base62", "A-Za-z0-9"))) + f" ELSE '{ALPHABETS['base64']}' END"


def _battery(df: DataFrame) -> DataFrame:
    """Turns the spans in _random into those that pass the tests and the control of false discoveries."""
    letters = "transform(array(rtrim('=', s.t)), core -> named_struct('s', s, 'core', core, 'abc', " + _choose() + "))[0]"
    df = df.withColumn("_runs", F.expr(f"transform(_random, s -> {letters})"))
    symbols = """named_struct('s', r.s, 'n', double(length(r.core)), 'a', double(length(r.abc)),
        'x', transform(split(r.core, ''), c -> double(instr(r.abc, c))),
        'sq', aggregate(split(r.abc, ''), 0D, (t, c) -> t + power(length(r.core) - length(replace(r.core, c, '')), 2)))"""
    df = df.withColumn("_runs", F.expr(f"transform(_runs, r -> {symbols})"))
    moments = """named_struct('s', r.s, 'n', r.n, 'a', r.a, 'x', r.x, 'chi', r.a * r.sq / r.n - r.n,
        'mu', aggregate(r.x, 0D, (t, v) -> t + v) / r.n, 'hi', aggregate(r.x, 0D, (t, v) -> t + if(2 * v > r.a, 1, 0)))"""
    df = df.withColumn("_runs", F.expr(f"transform(_runs, r -> {moments})"))
    sums = """named_struct('s', r.s, 'n', r.n, 'df', r.a - 1, 'chi', r.chi, 'mixed', 2 * r.hi * (r.n - r.hi) / r.n,
        'var', aggregate(r.x, 0D, (t, v) -> t + (v - r.mu) * (v - r.mu)),
        'cov', aggregate(zip_with(slice(r.x, 1, int(r.n) - 1), slice(r.x, 2, int(r.n) - 1), (v, w) -> (v - r.mu) * (w - r.mu)), 0D, (t, v) -> t + v),
        'changes', aggregate(zip_with(slice(r.x, 1, int(r.n) - 1), slice(r.x, 2, int(r.n) - 1), (v, w) -> if((2 * v > r.a) != (2 * w > r.a), 1D, 0D)), 1D, (t, v) -> t + v))"""
    df = df.withColumn("_runs", F.expr(f"transform(_runs, r -> {sums})"))
    scores = """named_struct('s', r.s, 'n', r.n,
        'z', array((power(r.chi / r.df, 1D / 3) - (1 - 2 / (9 * r.df))) / sqrt(2 / (9 * r.df)),
                   if(r.mixed * (r.mixed - 1) <= 0, 99D, abs(r.changes - 1 - r.mixed) / sqrt(r.mixed * (r.mixed - 1) / (r.n - 1))),
                   if(r.var <= 0, 99D, abs(r.cov / r.var + 1 / r.n) * sqrt(r.n))))"""
    df = df.withColumn("_runs", F.expr(f"transform(_runs, r -> {scores})"))
    # an upper bound for the tail of the normal distribution: one-sided for chi-squared, two-sided else
    tail = "exp(-0.717D * greatest(v, 0D) - 0.416D * v * v)"
    df = df.withColumn("_runs", F.expr(f"transform(_runs, r -> named_struct('s', r.s, 'n', r.n, 'q', transform(r.z, (v, i) -> greatest({tail} * if(i = 0, 0.5D, 1D), 1e-300D))))"))
    # Fisher: -2 * log sum is chi-squared with 6 degrees of freedom, whose tail has a closed form
    df = df.withColumn("_runs", F.expr("transform(_runs, r -> named_struct('s', r.s, 'n', r.n, 'worst', array_min(r.q), 'l', -aggregate(r.q, 0D, (t, v) -> t + ln(v))))"))
    fit = "exp(-r.l) * (1 + r.l + r.l * r.l / 2)"
    chance = f"exp(-r.n * if(r.s.t RLIKE '[0-9]', {GAP}D, {LETTERS_GAP}D))"
    df = df.withColumn("_runs", F.expr(f"transform(_runs, r -> named_struct('p', if(r.worst >= {LEVEL} / 3, least({chance} / ({fit}), 1D), 1D), 's', r.s))"))
    df = df.withColumn("_runs", F.expr("array_sort(_runs)"))
    cut = f"aggregate(transform(_runs, (r, i) -> if(r.p <= {FDR} * (i + 1) / size(_runs), i + 1, 0)), 0, (t, v) -> greatest(t, v))"
    return df.withColumn("_random", F.expr(f"transform(slice(_runs, 1, {cut}), r -> r.s)")).drop("_runs")


def scan(docs: DataFrame) -> DataFrame:
    """docs with _base and _all: arrays of (start, end, k, t), by start and kind. Takes names with _."""
    df = docs.withColumn("_text", F.coalesce("text", F.lit("")))
    df = df.withColumns({f"_{k}": F.regexp_extract_all("_text", F.lit(p), F.lit(0)) for k, p in PATTERNS.items()})
    df = df.withColumns({f"_{k}": _spans("_text", k) for k in KINDS})
    # value of the assignment: group 2 of the match
    df = df.withColumn("_assign", F.filter("_assign", lambda s: F.length(F.regexp_extract(s["t"], PATTERNS["assign"], 2)) >= 6))
    df = _battery(df)
    df = df.withColumn("_base", F.array_sort(F.concat("_assign", "_access", "_hex"), _by_start))
    new = F.filter("_random", lambda s: ~F.exists("_base", lambda b: (b["start"] <= s["start"]) & (s["end"] <= b["end"])))
    return df.withColumn("_all", F.array_sort(F.concat("_base", new), _by_start))


def _by_start(a: Column, b: Column) -> Column:
    return F.when(a["start"] != b["start"], F.signum(a["start"] - b["start"]).cast("int")).otherwise((a["k"] - b["k"]).cast("int"))


def _line(spans: str) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["k"]), s["start"], s["end"])), ",")


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random of every row."""
    return scan(docs.select("doc_id", "text")).select(
        "doc_id",
        *[F.size(f"_{k}").cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(_line("_base"), 256).alias("base_sha256"),
        _line("_all").alias("spans"),
        F.size(F.filter("_all", lambda s: s["k"] == KINDS.index("random"))).cast("long").alias("n_random"),
    )


def redact(docs: DataFrame) -> DataFrame:
    """docs with every span (overlapping ones as one) replaced by MARK and n_chars brought up to date.

    Null texts stay null. Works on any columns besides text; n_chars is only set if it is there.
    """
    cut = F.aggregate(
        "_all",
        F.struct(F.lit("").alias("out"), F.lit(0).alias("at")),
        lambda a, s: F.struct(
            F.when(s["start"] >= a["at"], F.concat(a["out"], F.substr(F.col("_text"), a["at"] + 1, s["start"] - a["at"]), F.lit(MARK))).otherwise(a["out"]).alias("out"),
            F.greatest(a["at"], s["end"]).alias("at"),
        ),
        lambda a: F.concat(a["out"], F.substr(F.col("_text"), a["at"] + 1, F.length("_text"))),
    )
    # the row travels as one struct, so its columns may have any names
    found = scan(docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), "text")).withColumn("_new", F.when(F.size("_all") > 0, cut).otherwise(F.col("text")))
    new = {"text": F.col("_new")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.size("_all") > 0, F.length("_new").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("row.n_chars"))
    return found.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
