"""Benchmark decontamination: broadcast n-gram set.

Test items are normalised to words and cut into windows of `window` words (a
shorter item is one window). The set of window hashes is broadcast; every
training text is cut into words once and its windows are looked up as one long
per window. What the hashes hit is verified word for word in the same scan, next
to the words. Hits are gathered by doc_id and 128 bits of hash of the text, each
once, so that a list is bounded by one text. No text is shuffled: only hits are,
and of all rows at most an id, the hashes and a number of words. All of it is
DataFrame expressions.

The set is as large as the benchmark. Its bytes, words and item_ids included, are
summed up first: up to BROADCAST_BYTES it is broadcast. A larger benchmark is
joined by a shuffle of hashes, and texts that hit are verified in a second scan,
whose texts are shuffled.

Defined cases: null or empty text has no words and no hits; an item without
words has no windows; a null item_id hits but is no item; rows that repeat a
doc_id are judged each by its own text; other columns of `docs` stay; an empty
benchmark hits nothing; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bytes of all windows up to which they are broadcast; ROW_BYTES of each are the row's own, beside words and items.
BROADCAST_BYTES, ROW_BYTES = 128 << 20, 64


def exact_words(text: Column) -> Column:
    """Words of a text with A-Z in lower case; null has none."""
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), CAPITALS, SMALL), F.lit(WORD), F.lit(0))


def word_count(text: Column) -> Column:
    """How many exact_words there are; small forms of other letters are letters too, and quicker to make."""
    return F.size(F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))).cast("long")


def benchmark_windows(benchmark: DataFrame, window: int = 13) -> DataFrame:
    """(hash, size, words, items) of every distinct window; `words` is one text."""
    items = benchmark.select("item_id", exact_words(F.col("text")).alias("exact"))
    items = items.withColumn("size", F.least(F.size("exact"), F.lit(window))).where("size > 0")
    items = items.withColumn("at", F.explode(F.expr("sequence(1, size(exact) - size + 1)")))
    one = F.expr("xxhash64(slice(exact, at, size))")
    whole = F.expr("array_join(slice(exact, at, size), ' ')")
    items = items.select(one.alias("hash"), "size", whole.alias("words"), "item_id")
    return items.groupBy("hash", "size", "words").agg(F.collect_set("item_id").alias("items"))


#: What tells the text of a row apart, under names of its own.
PLACE = ("hit_id", "hit_one", "hit_two")


def placed(docs: DataFrame) -> list[Column]:
    """The columns PLACE of every row."""
    text = docs["text"]
    marks = [F.xxhash64(text), F.xxhash64(F.lit(1), text)]
    return [c.alias(n) for c, n in zip([docs["doc_id"], *marks], PLACE, strict=True)]


def gathered_hits(docs: DataFrame, windows: DataFrame, sizes: list[int], small: bool = True) -> DataFrame:
    """(PLACE, n_words, found) of the texts that hit `windows`, of `sizes` words; `found` holds (at, size, items), each once."""
    texts = docs.select(*placed(docs), exact_words(docs["text"]).alias("exact"))
    texts = texts.withColumn("n_words", F.size("exact").cast("long"))
    hashes = [
        f"named_struct('size', {n}, 'hashes', if(size(exact) >= {n}, "
        f"transform(sequence(1, size(exact) - {n} + 1), at -> xxhash64(slice(exact, at, {n}))), cast(array() as array<bigint>)))"
        for n in sizes
    ]
    # the words stay beside their hashes only where no shuffle follows
    beside = [*PLACE, "n_words", *(["exact"] if small else [])]
    scan = texts.select(*beside, F.expr(f"inline(array({', '.join(hashes)}))"))
    scan = scan.select(*beside, "size", F.posexplode("hashes").alias("at", "hash"))
    hits = scan.join(F.broadcast(windows) if small else windows, ["hash", "size"])
    if small:
        hits = hits.where("array_join(slice(exact, at + 1, size), ' ') = words")
    hits = hits.groupBy(*PLACE).agg(F.max("n_words").alias("n_words"), F.collect_set(F.struct("at", "size", "words", "items")).alias("found"))
    if not small:
        own = [F.col(f"h.{n}").eqNullSafe(F.col(f"t.{n}")) for n in PLACE]
        same = F.expr("filter(found, h -> array_join(slice(exact, h.at + 1, h.size), ' ') = h.words)")
        met = hits.alias("h").join(texts.select(*PLACE, "exact").alias("t"), own)
        hits = met.select(*[F.col(f"h.{n}") for n in PLACE], "n_words", same.alias("found"))
        # rows of one place have one text and so the same hits
        hits = hits.where("size(found) > 0").groupBy(*PLACE).agg(F.max("n_words").alias("n_words"), F.first("found").alias("found"))
    return hits.select(*PLACE, "n_words", F.expr("transform(found, h -> struct(h.at as at, h.size as size, h.items as items))").alias("found"))


def judged_texts(docs: DataFrame, benchmark: DataFrame, window: int = 13) -> DataFrame | None:
    """(PLACE, n_hit, items, hits, contaminated) of the texts that hit, as a stored table; None if there are no windows."""
    windows = stored(benchmark_windows(benchmark, window))
    item_bytes = F.octet_length(F.array_join(F.col("items").cast("array<string>"), "")) + 16 * F.size("items")
    held = windows.groupBy("size").agg(F.sum(F.octet_length("words") + item_bytes + ROW_BYTES).alias("bytes")).collect()  # `window` rows at most
    if not held:
        return None
    found = gathered_hits(docs, windows, sorted(r["size"] for r in held), sum(r["bytes"] for r in held) <= BROADCAST_BYTES)
    found = found.withColumn("hits", F.expr("array_sort(array_distinct(transform(found, h -> struct(h.at as at, h.size as size))))"))
    reach = F.expr(
        "aggregate(hits, named_struct('reach', 0, 'n', 0L), (a, h) -> named_struct("
        "'reach', greatest(a.reach, h.at + h.size), "
        "'n', a.n + greatest(0, h.at + h.size - greatest(a.reach, h.at)))).n"
    )
    items = F.expr("array_sort(transform(array_distinct(flatten(transform(found, h -> h.items))), i -> cast(i as string)))")
    found = found.select(*PLACE, "n_words", reach.alias("n_hit"), items.alias("items"), "hits")
    judged = F.expr("n_hit > 0 and 20 * n_hit >= n_words")
    return stored(found.withColumn("contaminated", judged).drop("n_words"))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 13) -> DataFrame:
    """`docs` with n_words, n_hit, items (sorted as texts) and contaminated; `hits` holds (at, size) from 0.

    A word inside any occurrence of a window is hit. A text is contaminated
    where at least one word in twenty is hit.
    """
    keep = [c for c in docs.columns if c not in ("n_words", "n_hit", "items", "hits", "contaminated", *PLACE)]
    none = {"n_hit": "0L", "items": "cast(array() as array<string>)", "hits": "cast(array() as array<struct<at:int,size:int>>)", "contaminated": "false"}
    words = word_count(docs["text"]).alias("n_words")
    found = judged_texts(docs, benchmark, window)
    if found is None:
        return docs.select(*[docs[c] for c in keep], words, *[F.expr(e).alias(n) for n, e in none.items()])
    # what is not asked for later, texts above all, is pruned before this join
    rows = docs.select(*[docs[c] for c in keep], words, *placed(docs)).alias("d")
    own = [F.col(f"d.{n}").eqNullSafe(F.col(f"f.{n}")) for n in PLACE]
    filled = [F.coalesce(F.col(f"f.{n}"), F.expr(e)).alias(n) for n, e in none.items()]
    return rows.join(found.alias("f"), own, "left").select(*[rows[c] for c in keep], "n_words", *filled)


def digest(found: DataFrame) -> DataFrame:
    """The digest columns of `contamination`."""
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 13) -> DataFrame:
    """The rows of `docs` that are not contaminated, with their own columns.

    The contaminated texts are a stored table of known size, so Spark sends it to
    the rows where it is small.
    """
    found = judged_texts(docs, benchmark, window)
    if found is None:
        return docs
    bad = found.where("contaminated").select(*PLACE)
    own = [mine.eqNullSafe(bad[n]) for mine, n in zip(placed(docs), PLACE, strict=True)]
    return docs.join(bad, own, "left_anti")


ORACLE = r"""
WITH b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS win
  FROM b, unnest(range(1, greatest(len(w) - 13, 0) + 2)) t(i) WHERE len(w) > 0),
d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
ns AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, ns)),
h AS (SELECT doc_id, i, dw.n, item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.win = bw.win),
p AS (SELECT doc_id, count(DISTINCT i + k) AS n_hit FROM (SELECT doc_id, i, unnest(range(0, n)) AS k FROM h) GROUP BY doc_id),
q AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(id, ',' ORDER BY id)) AS items_sha256
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM h) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * n_hit >= len(w) AS contaminated
FROM d LEFT JOIN p ON d.doc_id = p.doc_id LEFT JOIN q ON d.doc_id = q.doc_id
"""
