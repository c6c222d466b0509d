"""Line dedup: exact windows of lines.

A window starts at each line that has words and takes as many such lines as
reach `min_words` words; another one ends at each line and takes as many lines
before it. Two hashes of all its lines stand for a window. Its smallest line hash
only leaves out early what occurs at one place; equal windows are equal in both
hashes, with no selection of windows and no extension of matches, so nothing
that winnowing would find is lost. A window that occurs at an earlier
place (smaller doc_id, then smaller hash of the text, then smaller line) is a
later repeat, and the lines in any later repeat go. The first place of every
line stays.

So any run of equal lines that has `min_words` words is found to its last line:
from each of its lines there are that many words ahead within the run, or
behind, or the line lies in the window that starts the run. Windows are counted
before they are shuffled, so a run that a third of all rows hold is one row per
task.

Defined cases: null text stays null, empty text empty; lines without words
belong to no window and go only between lines of a window that goes; texts of
fewer than `min_words` words keep all lines; rows of one doc_id with equal texts
are one place and do not remove each other's lines, with different texts they
are documents of their own, and so are rows without a doc_id; null doc_ids come
last; extra columns stay; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

MIN_WORDS = 50


def windows(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, text_hash, line, last, mark, mark_line, one, two) of every window; two hashes stand for its lines."""
    lines = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.split(F.coalesce("text", F.lit("")), "\n", -1).alias("all"))
    worded = (
        "filter(transform(all, (x, i) -> named_struct('line', i, 'n', regexp_count(x, '[^\\\\x20\\\\x09-\\\\x0D]+'), "
        "'a', xxhash64(x), 'b', xxhash64(1, x))), x -> x.n > 0)"
    )
    lines = lines.select("doc_id", "text_hash", F.expr(worded).alias("w"))
    lines = lines.where("size(w) > 0").select("doc_id", "text_hash", "w", F.expr("transform(w, x -> x.n)").alias("n"))
    # every line has a word, so a window has min_words lines at most
    size = (
        f"aggregate({{}}, named_struct('sum', 0, 'len', 0), "
        f"(acc, x) -> if(acc.sum >= {min_words}, acc, named_struct('sum', acc.sum + x, 'len', acc.len + 1)), "
        f"acc -> if(acc.sum >= {min_words}, acc.len, 0))"
    )
    ahead = size.format(f"slice(n, i, {min_words})")
    behind = size.format(f"reverse(slice(n, greatest(i - {min_words - 1}, 1), least(i, {min_words})))")
    found = lines.select(
        "doc_id",
        "text_hash",
        "w",
        F.expr(f"transform(sequence(1, size(n)), i -> {ahead})").alias("ahead"),
        F.expr(f"transform(sequence(1, size(n)), i -> {behind})").alias("behind"),
    )
    # (first place, lines) of both kinds; a window that is of both kinds is taken once
    spans = (
        "concat(transform(filter(sequence(1, size(w)), i -> ahead[i - 1] > 0), i -> named_struct('at', i, 'len', ahead[i - 1])), "
        "transform(filter(sequence(1, size(w)), i -> behind[i - 1] > 0 and ahead[i - behind[i - 1]] <> behind[i - 1]), "
        "i -> named_struct('at', i - behind[i - 1] + 1, 'len', behind[i - 1])))"
    )
    found = found.select("doc_id", "text_hash", "w", F.expr(spans).alias("spans"))
    # the mark: the smallest hash, and its line
    own = (
        "transform(spans, s -> named_struct("
        "'first', w[s.at - 1].line, 'last', w[s.at + s.len - 2].line, "
        "'mark', array_min(transform(slice(w, s.at, s.len), x -> named_struct('a', x.a, 'line', x.line))), "
        "'one', xxhash64(transform(slice(w, s.at, s.len), x -> x.a)), "
        "'two', xxhash64(transform(slice(w, s.at, s.len), x -> x.b))))"
    )
    found = found.select("doc_id", "text_hash", F.expr(f"inline({own})"))
    mark = (F.col("mark.a").alias("mark"), F.col("mark.line").alias("mark_line"))
    return found.select("doc_id", "text_hash", F.col("first").alias("line"), "last", *mark, "one", "two")


def later_repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, text_hash, line, last) of the windows that occur at an earlier place."""
    found = stored(windows(docs, min_words))
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash", "mark_line")
    marks = found.groupBy("mark").agg(F.min(place).alias("least"), F.max(place).alias("most")).where("least <> most")
    around = found.join(marks.select("mark"), "mark", "left_semi")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash", "line")
    firsts = around.groupBy("mark", "one", "two").agg(F.min(place).alias("least"), F.max(place).alias("most")).where("least <> most")
    later = found.join(firsts.select("mark", "one", "two", "least"), ["mark", "one", "two"])
    return later.where(~place.eqNullSafe(F.col("least"))).select("doc_id", "text_hash", "line", "last")


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """`docs` with the later repeats taken out of `text`; `n_lines` and `n_removed` count its lines."""
    gone = later_repeats(docs, min_words).groupBy(F.col("doc_id").alias("hit_id"), F.col("text_hash").alias("hit_hash"))
    gone = gone.agg(F.collect_set(F.struct("line", "last")).alias("runs"))
    keep = [c for c in docs.columns if c not in ("text", "n_lines", "n_removed")]
    same = docs["doc_id"].eqNullSafe(gone["hit_id"]) & (F.xxhash64(docs["text"]) == gone["hit_hash"])
    rows = docs.join(gone, same, "left")
    rows = rows.select(*[docs[c] for c in keep], docs["text"], gone["runs"].alias("_runs"), F.split(docs["text"], "\n", -1).alias("_lines"))
    rows = rows.withColumn("_gone", F.expr("array_distinct(flatten(transform(_runs, r -> sequence(r.line, r.last))))"))
    rows = rows.withColumn("_kept", F.expr("array_except(sequence(0, size(_lines) - 1), _gone)"))
    text = F.expr("if(_gone is null, text, array_join(transform(_kept, i -> _lines[i]), '\n'))")
    return rows.select(
        *keep,
        text.alias("text"),
        F.coalesce(F.size("_lines"), F.lit(0)).cast("long").alias("n_lines"),
        F.expr("cast(if(_gone is null or _lines is null, 0, size(_lines) - size(_kept)) as bigint)").alias("n_removed"),
    )


def digest(deduped: DataFrame) -> DataFrame:
    """(doc_id, n_lines, n_removed, kept_sha256) of dedup_lines; null text counts as empty."""
    return deduped.select(
        "doc_id", F.greatest("n_lines", F.lit(0)).alias("n_lines"), "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    )


ORACLE = r"""
WITH l AS (
  SELECT doc_id, unnest(lines) AS x, unnest(range(0, len(lines))) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents)),
c AS (SELECT doc_id, line, x, len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) AS n FROM l),
s AS (SELECT *, sum(n) OVER (PARTITION BY doc_id ORDER BY line) AS upto FROM c WHERE n > 0),
w AS (
  SELECT doc_id, line, max(line) OVER f AS last, sum(n) OVER f AS total, list(x) OVER f AS xs
  FROM (SELECT *, upto - n AS before FROM s) WINDOW f AS (PARTITION BY doc_id ORDER BY before RANGE BETWEEN CURRENT ROW AND 49 FOLLOWING)
  UNION
  SELECT doc_id, min(line) OVER f AS line, line AS last, sum(n) OVER f AS total, list(x) OVER f AS xs
  FROM s WINDOW f AS (PARTITION BY doc_id ORDER BY upto RANGE BETWEEN 49 PRECEDING AND CURRENT ROW)),
r AS (
  SELECT *, row_number() OVER (PARTITION BY xs ORDER BY doc_id, line) AS nth FROM w WHERE total >= 50),
g AS (SELECT DISTINCT doc_id, unnest(range(line, last + 1)) AS line FROM r WHERE nth > 1),
k AS (SELECT c.*, g.line IS NOT NULL AS gone FROM c LEFT JOIN g ON c.doc_id = g.doc_id AND c.line = g.line)
SELECT d.doc_id, CAST(if(d.text IS NULL, 0, count(*)) AS BIGINT) AS n_lines, CAST(count(*) FILTER (gone) AS BIGINT) AS n_removed,
       sha256(coalesce(string_agg(x, chr(10) ORDER BY line) FILTER (NOT gone), '')) AS kept_sha256
FROM documents d JOIN k ON d.doc_id = k.doc_id GROUP BY d.doc_id, d.text
"""
