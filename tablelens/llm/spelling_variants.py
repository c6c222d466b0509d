"""Spelling variant grouping: finite-state composition.

The vocabulary is an acyclic acceptor A with as few states as possible. E is the
transducer that changes exactly one code point: it copies, makes one edit
(replace, insert, delete) and copies again; after inserting a symbol it does not
read that symbol next, so every pair of near words has one path. The accepted
pairs of the composition A o E o A are the pairs of near words. Its states are
(p, untouched, p) before and (p, edited, q) after the edit, so what follows an
edit is the intersection of the right languages of p and q, kept per pair of
states.

Spark partitions the composition by its initial state: two near words of which
the shorter has m code points share all but a segment [lo, hi) of their positions,
the one that holds the edit. The words of a class m that share the rest of
their symbols are one partition, which composes the acceptor of their segments
only. A word lies in the class of its own length and in that of one less, once
for every segment. Segments start as halves; a partition of more than LIMIT words
is halved again, down to one position, where no more words fit than the square of
the alphabet. So the memory of a partition is bounded, and a pair is found in just
the segment of its edit. Partitions write one row per word, not one per pair.

Counts run over all tokens of all texts as built-in expressions with partial
aggregation. Forms are followed to their ends by doubling the pointers; a form is
`ratio` times as frequent as its word, so chains are as short as the logarithm of
the largest count.

Defined cases: null and empty texts hold no word; a null doc_id counts as empty
text in the digest; repeated rows count as often as they occur; ties of n go to
the smallest word in code-point order; extra columns are not read; an empty
table, or one without a frequent word, gives an empty result.
"""

from __future__ import annotations

import string
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

#: Words of a partition that are composed at once.
LIMIT = 50_000
#: Positions of a segment that are composed at once (longer words have more segments).
SEGMENT = 256
LETTERS = "A-Za-z\u00c0-\u00ff"

#: The digest by its rule: 256 remainders of the bytes, then one step per byte.
ORACLE = r"""
WITH RECURSIVE remainders AS (
  SELECT list_transform(range(256), lambda b: list_reduce(range(8),
           lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b)) AS t
), runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all("text", '[A-Za-z\x{00C0}-\x{00FF}]+')),
                           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents
), tokens AS (
  SELECT doc_id, run, count(*) AS k FROM runs WHERE length(run) >= 6 GROUP BY ALL
), bytes AS (
  SELECT run, k, list_transform(string_split(regexp_replace(hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)), '(..)', ' \1', 'g'), ' ')[2:],
                                lambda x: ('0x' || x)::BIGINT) AS b FROM tokens
), marked AS (
  SELECT run, k, xor(list_reduce(b, lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]), 4294967295::BIGINT), 4294967295) AS h
  FROM bytes, remainders
), cut AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, k FROM marked
), words AS (
  SELECT word, sum(k)::BIGINT AS n FROM cut WHERE length(word) >= 6 GROUP BY word HAVING sum(k) >= 5
), holes AS (
  SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words
), less AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM holes
), near AS (
  SELECT a.word, b.word AS other, b.n FROM less a JOIN less b USING (i, rest) WHERE a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM less a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM less a JOIN words b ON a.rest = b.word
), best AS (
  SELECT word, count(*) AS n_near, max(n) AS top, arg_min(other, (-n, encode(other))) AS other FROM near GROUP BY word
), formed AS (
  SELECT word, words.n, coalesce(n_near, 0)::BIGINT AS n_near,
         CASE WHEN top >= 5 * words.n THEN other END AS form, CASE WHEN top >= 5 * words.n THEN top END::BIGINT AS form_n
  FROM words LEFT JOIN best USING (word)
), walk AS (
  SELECT word, word AS at, form AS further FROM formed
  UNION ALL
  SELECT walk.word, further, formed.form FROM walk JOIN formed ON formed.word = further
)
SELECT word, n, n_near, form, form_n, walk.at AS root
FROM formed JOIN walk USING (word) WHERE further IS NULL
"""

# ---------------------------------------------------------------- words


def lower_ascii(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def vocabulary(docs: DataFrame, shortest: int = 6, least: int = 5, every: int = 199) -> DataFrame:
    """(word, n) of the words with at least `shortest` code points and `least` occurrences.

    One token of `every`, chosen by the crc32 of `<doc_id>:<token>`, loses the
    code point that the same number names.
    """
    # a shorter run gives no word, and no part of it matches
    runs = F.regexp_extract_all("text", F.lit(f"[{LETTERS}]{{{shortest},}}"), F.lit(0))
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    tokens = docs.select(name.alias("name"), F.explode(runs).alias("run")).select("name", lower_ascii(F.col("run")).alias("run"))
    mark = F.crc32(F.concat("name", F.lit(":"), "run").cast("binary"))
    tokens = tokens.select("run", mark.alias("mark"))
    at = F.pmod("mark", F.length("run")).cast("int")
    shorter = F.concat(F.left("run", at), F.substring(F.col("run"), at + 2, F.length("run")))
    tokens = tokens.select(F.when(F.col("mark") % every == 0, shorter).otherwise(F.col("run")).alias("word"))
    counted = tokens.where(F.length("word") >= shortest).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= least)


# ---------------------------------------------------------------- the automata


class Acceptor:
    """The smallest acyclic acceptor of sorted distinct words: arcs[p] maps a symbol to the next state."""

    def __init__(self, words: Iterable[str]) -> None:
        self.arcs: list[dict[str, int]] = []
        self.final: list[bool] = []
        known: dict[tuple, int] = {}  # states that are done, by what they accept
        path: list[tuple[list[bool], dict[str, int]]] = [([False], {})]  # of the last word, not yet done
        last = ""

        def close(depth: int) -> None:
            while len(path) > depth + 1:
                (final,), arcs = path.pop()
                like = (final, *arcs.items())
                state = known.get(like)
                if state is None:
                    state = known[like] = len(self.arcs)
                    self.arcs.append(arcs)
                    self.final.append(final)
                path[-1][1][last[len(path) - 1]] = state

        for word in words:
            depth, most = 0, min(len(word), len(last))
            while depth < most and word[depth] == last[depth]:
                depth += 1
            close(depth)
            path += [([False], {}) for _ in word[depth:]]
            path[-1][0][0] = True
            last = word
        close(0)
        (final,), arcs = path[0]
        self.root = len(self.arcs)
        self.arcs.append(arcs)
        self.final.append(final)


class OneEdit:
    """The composition of an acceptor with the one-edit transducer and the acceptor again."""

    def __init__(self, acceptor: Acceptor) -> None:
        self.arcs, self.final, self.root = acceptor.arcs, acceptor.final, acceptor.root
        self._common: dict[tuple[int, int], list[str]] = {}
        self._edits: list[list[tuple[str, str]]] = []
        self._live: list[bool] = []
        for p, arcs in enumerate(self.arcs):  # a state comes after all states it leads to
            edits = self._at(p)
            self._edits.append(edits)
            self._live.append(bool(edits) or any(self._live[q] for q in arcs.values()))

    def common(self, p: int, q: int) -> list[str]:
        """What both states accept: the words from (p, edited, q) on."""
        if p > q:
            p, q = q, p
        found = self._common.get((p, q))
        if found is None:
            one, two = self.arcs[p], self.arcs[q]
            if len(one) > len(two):
                one, two = two, one
            found = [""] if self.final[p] and self.final[q] else []
            for symbol, state in one.items():
                other = two.get(symbol)
                if other is not None:
                    found += [symbol + rest for rest in self.common(state, other)]
            self._common[p, q] = found
        return found

    def _at(self, p: int) -> list[tuple[str, str]]:
        """The pairs of rests with the edit at (p, untouched, p)."""
        out, arcs = [], list(self.arcs[p].items())
        for k, (a, one) in enumerate(arcs):
            for b, two in arcs[:k]:
                out += [(b + rest, a + rest) for rest in self.common(one, two)]
            out += [(rest, a + rest) for rest in self.common(p, one) if rest[:1] != a]
        return out

    def pairs(self) -> Iterator[tuple[str, str]]:
        """Every pair of words that differ by one edit, once."""
        open_ = [(self.root, "")] if self._live[self.root] else []
        while open_:
            p, start = open_.pop()
            for x, y in self._edits[p]:
                yield start + x, start + y
            open_ += [(q, start + a) for a, q in self.arcs[p].items() if self._live[q]]


# ---------------------------------------------------------------- partitions


def in_segments(rows: DataFrame) -> DataFrame:
    """`rows` (word, n, m, lo, hi) with the key of the partition and the segment of the word."""
    tail = F.col("m") - F.col("hi")
    rest = F.length("word") - F.col("lo") - tail
    key = F.concat(F.left("word", F.col("lo")), F.lit("\0"), F.when(tail > 0, F.right("word", tail)).otherwise(""))
    return rows.select("word", "n", "m", "lo", "hi", key.alias("key"), F.substring(F.col("word"), F.col("lo") + 1, rest).alias("part"))


def halves(rows: DataFrame) -> DataFrame:
    """`rows` with each segment [lo, hi) cut in two."""
    middle = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
    both = F.array(F.struct(F.col("lo"), middle.alias("hi")), F.struct(middle.alias("lo"), F.col("hi")))
    return rows.select("word", "n", "m", F.explode(both).alias("s")).select("word", "n", "m", "s.lo", "s.hi")


def partitions(words: DataFrame) -> DataFrame:
    """(word, n, m, lo, hi, key, part): every word in its partitions, none of more than LIMIT words."""
    size = F.length("word")
    classes = words.select("word", "n", F.explode(F.array(size, size - 1)).alias("m")).where("m > 0")
    pieces = F.greatest(F.lit(2), F.ceil(F.col("m") / SEGMENT)).cast("int")  # a word of one code point has an empty segment
    starts = classes.select("*", pieces.alias("pieces")).select("*", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("k"))
    bound = [F.floor((F.col("k") + j) * F.col("m") / F.col("pieces")).cast("int") for j in (0, 1)]
    now = starts.select("word", "n", "m", bound[0].alias("lo"), bound[1].alias("hi")).where("lo < hi")
    done = None
    while True:
        now = stored(in_segments(now))
        one = ["m", "lo", "hi", "key"]
        large = stored(now.groupBy(*one).count().where((F.col("count") > LIMIT) & (F.col("hi") - F.col("lo") > 1)).select(*one))
        if large.isEmpty():
            return now if done is None else done.unionByName(now)
        small = now.join(large, one, "left_anti")
        done = small if done is None else done.unionByName(small)
        now = halves(now.join(large, one, "left_semi").select("word", "n", "m", "lo", "hi"))


def compose(parts: list[str], width: int, is_last: bool) -> Iterator[tuple[str, str]]:
    """The pairs of sorted segments of a partition that differ by one edit, each pair in the partition of its edit."""
    for x, y in OneEdit(Acceptor(parts)).pairs():
        if len(x) > width:
            continue  # both words are one longer than the class: the pair is of the next class
        if is_last or not y.startswith(x):  # else the edit comes after the segment
            yield x, y


def near_words(rows: DataFrame) -> DataFrame:
    """(word, n_near, best_n, best) per word and partition: how many near words it has there, and the most frequent."""
    out = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())])

    def of(group: dict[str, tuple[str, int]], m: int, lo: int, hi: int) -> Iterator[pa.RecordBatch]:
        near: dict[str, list] = {}
        for x, y in compose(list(group), hi - lo, hi == m):
            for a, b in ((x, y), (y, x)):
                word, n = group[b]
                held = near.get(a)
                if held is None:
                    near[a] = [1, (-n, word)]
                else:
                    held[0] += 1
                    held[1] = min(held[1], (-n, word))
        if near:
            columns = zip(*((group[a][0], count, -less, best) for a, (count, (less, best)) in near.items()), strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, out.types, strict=True)], schema=out)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, group = None, {}
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("m", "lo", "hi", "key", "part", "word", "n")]
            for m, lo, hi, key, part, word, n in zip(*columns, strict=True):
                if (m, lo, hi, key) != current:
                    if len(group) > 1:
                        yield from of(group, *current[:3])
                    current, group = (m, lo, hi, key), {}
                group[part] = (word, n)
        if len(group) > 1:
            yield from of(group, *current[:3])

    dealt = rows.repartition("m", "lo", "hi", "key").sortWithinPartitions("m", "lo", "hi", "key", "part")
    return dealt.mapInArrow(run, "word string, n_near long, best_n long, best string")


def followed(forms: DataFrame) -> DataFrame:
    """(word, root) of `forms` (word, form): where following forms ends."""
    now = stored(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = stored(now.join(ahead, "root", "left"))
        if moved.where("further is not null").isEmpty():
            return now
        now = moved.select("word", F.coalesce("further", "root").alias("root"))


def variants(words: DataFrame, ratio: int = 5) -> DataFrame:
    """`words` (word, n; distinct words) with n_near, form, form_n and root."""
    words = stored(words.select("word", "n"))
    found = near_words(partitions(words)).groupBy("word").agg(
        F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("less"), "best")).alias("top")
    )
    frequent = -F.col("top.less") >= ratio * F.col("n")
    known = words.join(found, "word", "left").select(
        "word", "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(frequent, F.col("top.best")).alias("form"),
        F.when(frequent, -F.col("top.less")).alias("form_n"),
    )
    known = stored(known)
    roots = followed(known.where("form is not null"))
    return known.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))


def spelling_variants(docs: DataFrame, shortest: int = 6, least: int = 5, every: int = 199, ratio: int = 5) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of the frequent words of `docs`; see vocabulary and variants."""
    return variants(vocabulary(docs, shortest, least, every), ratio)
