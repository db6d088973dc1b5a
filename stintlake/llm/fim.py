"""Fill-in-the-middle forms of texts by a counted-quantifier regex, in built-in functions only.

A text is a sequence of units (by default lines). regexp_count gives their number n, two digits of a
hash of the id give the cuts a <= b, and one pattern made for the row,
(unit{a})(unit{b-a})(rest), captures prefix, middle and suffix in a single match, whose replacement
already is the output. The counted groups are possessive: a unit never gives characters back, so the
match needs neither backtracking nor a stack that grows with the number of units, and a text of any
length takes time in proportion to it.

Forms: psm is PREFIX prefix SUFFIX suffix MIDDLE middle, spm is SUFFIX suffix PREFIX prefix MIDDLE middle,
plain is the text itself. A text that is empty or contains a marker is always plain, so the markers of an
output can be told from its text: a marker can't arise where text and marker meet, as it has its only '<'
at its start. restore() thus gives back exactly the text, and the lengths of the parts are read off the
places of the markers.

Null texts count as empty (n = 0, plain). A null doc_id is hashed as the text 'null'. Rows with the same
doc_id and text give the same result each; an empty table gives an empty result. transform() keeps all
columns, whatever their names; every new column is put into one struct that the caller names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A line with its end, or the last line without one.
LINES = r"[^\n]*\n|[^\n]+"
SEED, FORM_PERCENT, SPM_PERCENT = 7, 100, 50
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"


def digits(doc_id: Column, group: int, seed: int = SEED) -> Column:
    """The group-th run of 8 hex digits (from 1) of the sha256 of seed:doc_id, as a number."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.sha2(key, 256), 8 * group - 7, 8), 16, 10).cast("long")


def _pattern(unit: str, a: Column, b: Column) -> Column:
    """(?s)\\A (unit{a}) (unit{b-a}) (rest) \\z with possessive counts."""
    counted = lambda n: F.concat(F.lit(f"((?:{unit}){{"), n.cast("string"), F.lit("}+)"))
    return F.concat(F.lit(r"(?s)\A"), counted(a), counted(b - a), F.lit(r"(.*+)\z"))


def transform(docs: DataFrame, into: str = "fim", unit: str = LINES, seed: int = SEED, form_percent: int = FORM_PERCENT, spm_percent: int = SPM_PERCENT) -> DataFrame:
    """docs with a struct column `into`: n, form, output, prefix_chars, middle_chars (null if plain).

    `unit` is a Java pattern whose matches, one after the other, make up the whole of any text, without
    capturing groups; an `into` that docs has already is replaced.
    """
    row = F.struct(*[docs[c] for c in docs.columns])  # travels as one, so its columns may have any names
    df = docs.select(row.alias("row"), F.coalesce(docs["text"], F.lit("")).alias("text"), docs["doc_id"].alias("id"))
    df = df.withColumn("n", F.regexp_count("text", F.lit(unit)).cast("long"))
    cut = [F.pmod(digits(F.col("id"), k, seed), F.col("n") + 1) for k in (1, 2)]
    marked = F.lit(False)
    for marker in (PREFIX, SUFFIX, MIDDLE):
        marked = marked | F.contains("text", F.lit(marker))
    plain = (F.col("n") == 0) | marked | (F.pmod(digits(F.col("id"), 3, seed), F.lit(100)) >= form_percent)
    spm = F.pmod(digits(F.col("id"), 4, seed), F.lit(100)) < spm_percent
    df = df.withColumns({"a": F.least(*cut), "b": F.greatest(*cut), "form": F.when(plain, "plain").when(spm, "spm").otherwise("psm")})
    places = F.when(F.col("form") == "spm", f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2").otherwise(f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2")
    df = df.withColumn("output", F.when(F.col("form") == "plain", F.col("text")).otherwise(F.regexp_replace("text", _pattern(unit, F.col("a"), F.col("b")), places)))
    at = {m: F.instr("output", F.lit(m)) for m in (PREFIX, SUFFIX, MIDDLE)}
    after_prefix = F.when(F.col("form") == "spm", at[MIDDLE]).when(F.col("form") == "psm", at[SUFFIX])
    made = F.struct(
        "n",
        "form",
        "output",
        (after_prefix - at[PREFIX] - len(PREFIX)).cast("long").alias("prefix_chars"),
        F.when(F.col("form") != "plain", F.length("output") - at[MIDDLE] - len(MIDDLE) + 1).cast("long").alias("middle_chars"),
    )
    return df.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns if c != into], made.alias(into))


def restore(output: Column, form: Column) -> Column:
    """The text that an output of this form was made from, again by one match."""
    parts = lambda *markers: r"(?s)\A" + "(.*?)".join(markers) + r"(.*+)\z"
    psm = F.regexp_replace(output, parts(PREFIX, SUFFIX, MIDDLE), "$1$3$2")
    spm = F.regexp_replace(output, parts(SUFFIX, PREFIX, MIDDLE), "$2$3$1")
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256 of every row."""
    made = transform(docs.select("doc_id", "text"))
    return made.select(
        "doc_id",
        "fim.n",
        "fim.form",
        "fim.prefix_chars",
        "fim.middle_chars",
        F.sha2("fim.output", 256).alias("output_sha256"),
        F.sha2(restore(F.col("fim.output"), F.col("fim.form")), 256).alias("restored_sha256"),
    )


_HEX = "CAST('0x' || substr(sha256('{seed}:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), {at}, 8) AS BIGINT)"
_H = [_HEX.format(seed=SEED, at=8 * k + 1) for k in range(4)]
ORACLE_SQL = f"""
WITH units AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\n]*\\n|[^\\n]+') AS u, {", ".join(f"{h} AS h{k}" for k, h in enumerate(_H, 1))} FROM documents),
cuts AS (SELECT *, len(u) AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b,
  CASE WHEN t = '' OR contains(t, '{PREFIX}') OR contains(t, '{SUFFIX}') OR contains(t, '{MIDDLE}') OR h3 % 100 >= {FORM_PERCENT} THEN 'plain' WHEN h4 % 100 < {SPM_PERCENT} THEN 'spm' ELSE 'psm' END AS form FROM units),
parts AS (SELECT *, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m, array_to_string(u[b + 1:], '') AS s FROM cuts)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars, CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '{PREFIX}' || p || '{SUFFIX}' || s || '{MIDDLE}' || m ELSE '{SUFFIX}' || s || '{PREFIX}' || p || '{MIDDLE}' || m END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM parts
"""
