"""Fill-in-middle transformation: counted-quantifier regex.

A text of n units (code points) is cut after a and after b units, a <= b, drawn
from the digest of a seed and the doc_id. One regular expression per row,
`(unit{a}+)(unit{b-a}+)(unit*+)`, matches the whole text once: its possessive
counted groups never give back what they took, so the match is one pass from
left to right whatever the text holds, and the replacement puts the captured
parts between the sentinels in the order of the form. regexp_count gives n.
Everything is a built-in expression over one row: no shuffle, no join, and one
pass over the table.

Defined cases: null text is empty; an empty text, and one that holds a
sentinel, stays as it is (form `plain`); a null doc_id draws as the seed alone
does; equal rows give equal rows; extra columns stay, those named like a result
are replaced.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Units that are counted as one match first, so that counting a very long text makes few matches.
BLOCK = 64
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

ORACLE = """
WITH units AS (
  SELECT doc_id, coalesce("text", '') AS t, length(coalesce("text", ''))::BIGINT AS n,
         sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h
  FROM documents
), drawn AS (
  SELECT *, ('0x' || substr(h, 1, 8))::BIGINT % (n + 1) AS c1, ('0x' || substr(h, 9, 8))::BIGINT % (n + 1) AS c2,
         CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                OR ('0x' || substr(h, 17, 8))::BIGINT % 100 >= 90 THEN 'plain'
              WHEN ('0x' || substr(h, 25, 8))::BIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM units
), cut AS (
  SELECT *, least(c1, c2) AS a, greatest(c1, c2) AS b FROM drawn
), parts AS (
  SELECT *, substr(t, 1, a) AS p, substr(t, a + 1, b - a) AS m, substr(t, b + 1) AS s FROM cut
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
              ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parts
"""


def count_units(text: Column) -> Column:
    """How many units (code points, line ends too) `text` has.

    Whole blocks are counted as one match each, then the units of what is left:
    a unit at a time would make a string of every code point.
    """
    left = F.regexp_replace(text, f"(?s)\\A(?:.{{{BLOCK}}})*+", "")
    return (BLOCK * F.regexp_count(text, F.lit(f"(?s).{{{BLOCK}}}")) + F.regexp_count(left, F.lit("(?s)."))).cast("long")


def drawn(doc_id: Column, seed: str, number: int) -> Column:
    """The `number`-th (from 1) 32-bit unsigned integer of the digest of seed and doc_id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return F.conv(F.substring(digest, 8 * number - 7, 8), 16, 10).cast("long")


def quoted(sentinel: str) -> tuple[str, str]:
    """`sentinel` as a pattern and as a replacement that mean just its characters."""
    return re.sub(r"(\W)", r"\\\1", sentinel), re.sub(r"([\\$])", r"\\\1", sentinel)


def fill_in_middle(
    docs: DataFrame,
    seed: str = "1",
    transform_percent: int = 90,
    spm_percent: int = 20,
    sentinels: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE),
) -> DataFrame:
    """`docs` with n, form, prefix_chars, middle_chars and output, the text in its form."""
    p, s, m = (quoted(x)[1] for x in sentinels)
    text, doc_id = F.coalesce(F.col("text"), F.lit("")), F.col("doc_id")
    cuts = [F.pmod(drawn(doc_id, seed, k), F.col("n") + 1) for k in (1, 2)]
    held = F.lit(False)
    for sentinel in sentinels:
        held = held | F.contains(text, F.lit(sentinel))
    plain = (text == "") | held | (drawn(doc_id, seed, 3) % 100 >= transform_percent)
    form = F.when(plain, "plain").when(drawn(doc_id, seed, 4) % 100 < spm_percent, "spm").otherwise("psm")
    # one column at a time: what a later one uses is computed once
    found = docs.withColumn("n", count_units(text)).withColumn("form", form)
    found = found.withColumn("prefix_chars", F.when(F.col("form") != "plain", F.least(*cuts)))
    found = found.withColumn("middle_chars", F.when(F.col("form") != "plain", F.greatest(*cuts) - F.col("prefix_chars")))
    pattern = F.format_string("(?s)\\A(.{%d}+)(.{%d}+)(.*+)\\z", "prefix_chars", "middle_chars")
    order = F.when(F.col("form") == "psm", f"{p}$1{s}$3{m}$2").otherwise(f"{s}$3{p}$1{m}$2")
    cut = F.regexp_replace(text, pattern, order)
    return found.withColumn("output", F.when(F.col("form") == "plain", text).otherwise(cut))


def before(sentinel: str) -> str:
    """A pattern of all characters up to `sentinel`, which never goes back."""
    first, rest = quoted(sentinel[0])[0], quoted(sentinel[1:])[0]
    return f"([^{first}]*+(?:{first}(?!{rest})[^{first}]*+)*+)"


def restored(output: Column, form: Column, sentinels: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE)) -> Column:
    """The text that `output` was made of; a sentinel occurs in it only where the form put it."""
    p, s, m = (quoted(x)[0] for x in sentinels)
    end = f"{before(sentinels[2])}{m}(.*+)\\z"
    pattern = F.when(form == "psm", f"(?s)\\A{p}{before(sentinels[1])}{s}{end}").otherwise(f"(?s)\\A{s}{before(sentinels[0])}{p}{end}")
    order = F.when(form == "psm", "$1$3$2").otherwise("$2$3$1")
    return F.when(form == "plain", output).otherwise(F.regexp_replace(output, pattern, order))


def digest(found: DataFrame) -> DataFrame:
    """The result of fill_in_middle with digests in place of texts."""
    return found.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )
