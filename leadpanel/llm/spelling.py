"""Spelling variants by a dictionary of trie-node pairs.

The nodes of a trie of all words and of a trie of all reversed words are
numbered. A word with its place i skipped is the pair (node of what stands
before, node of what stands after); a word cut before its place i is such a
pair too. Two words share a skipped pair when they differ in that one place,
and the skipped pair of one is a cut pair of another when one more letter is
all that parts them. So equal integer pairs are exactly the near words, and a
pair has as many words as there are letters, plus one.

Both tries are numbered in sorted runs: a node belongs to the first word that
has it and is that word's place in the sum of lengths plus the node's depth.
What a run's first words share with the run before is handed on by the driver,
one path per run.

Cases: null and empty texts have no words; a null id counts as an empty text
in the hash; rows that repeat count each; words of any length are whole; ties
of counts go to the smaller word in code-point order; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from leadpanel.operators.runs import scan, sorted_runs, summaries
from leadpanel.session import pin, spread

#: A run of letters in a row is hit by the deletion when its hash is divisible by this.
EVERY = 199
MIN_LENGTH, MIN_COUNT = 6, 5
#: A form is this many times as frequent as the word.
RATIO = 5
#: Distinct words a task counts before it hands them on; bounds its memory.
COUNTED = 200_000
#: Rows of a batch that become Python strings at a time, and pairs that become one batch.
ROWS, PAIRS = 256, 100_000

#: Latin-1 bytes: letters stay, A-Z in lower case, and all else parts words.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256))


def words_of(doc_id, text: str, min_length: int = MIN_LENGTH, every: int = EVERY) -> Iterator[tuple[bytes, int]]:
    """``(word in Latin-1, occurrences)`` of one text, after the deletions."""
    seed = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    # Characters past Latin-1 are no letters here; each becomes one question mark.
    for word, n in Counter(text.encode("latin-1", "replace").translate(_LETTERS).split()).items():
        if len(word) < min_length:
            continue
        h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), seed)
        if h % every == 0:
            at = h % len(word)
            word = word[:at] + word[at + 1:]
            if len(word) < min_length:
                continue
        yield word, n


def count_words(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, every: int = EVERY) -> DataFrame:
    """``word, n`` of the words of at least ``min_length`` letters that occur at least ``min_count`` times."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, int] = {}

        def out() -> pa.RecordBatch:
            words = pa.array([word.decode("latin-1") for word in seen], pa.string())
            return pa.RecordBatch.from_arrays([words, pa.array(list(seen.values()), pa.int64())], ["word", "n"])

        for batch in batches:
            for low in range(0, batch.num_rows, ROWS):
                part = batch.slice(low, ROWS)
                for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                    for word, n in words_of(doc_id, text or "", min_length, every):
                        seen[word] = seen.get(word, 0) + n
                if len(seen) > COUNTED:
                    yield out()
                    seen.clear()
        yield out()

    found = spread(docs.select("doc_id", "text")).mapInArrow(counted, "word string, n bigint")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


# ---- numbered tries --------------------------------------------------------------------
def common(left: str, right: str) -> int:
    """Length of the common beginning."""
    for at, (a, b) in enumerate(zip(left, right)):
        if a != b:
            return at
    return min(len(left), len(right))


class Path:
    """The trie path of the last word of a sorted scan: its text and its nodes by depth."""

    def __init__(self, text: str = "", nodes: list[int] | None = None, base: int = 0):
        self.text, self.nodes, self.base = text, nodes or [], base

    def begin(self) -> Path:
        """A copy to go on from; what is broadcast stays as it is."""
        return Path(self.text, self.nodes, self.base)

    def to(self, word: str) -> list[int]:
        """The nodes of the next word; the ones it does not share with the last word are new."""
        shared = common(self.text, word)
        self.nodes = self.nodes[:shared] + list(range(self.base + shared + 1, self.base + len(word) + 1))
        self.text, self.base = word, self.base + len(word)
        return self.nodes


def paths_of_runs(runs: DataFrame, column: str) -> dict[int, Path]:
    """Where each run's numbering begins: the sum of lengths before it and the path it shares with the run before."""

    def summary(batches: Iterator[pa.RecordBatch]) -> dict:
        path, first = Path(), None
        for batch in batches:
            for word in batch.column(column).to_pylist():
                first = word if first is None else first
                path.to(word)
        return {"first": first, "last": path.text, "nodes": path.nodes, "total": path.base}

    out, before = {}, Path()
    for row in summaries(runs, summary, "first string, last string, nodes array<bigint>, total bigint"):
        shared = common(before.text, row["first"])
        out[row["_run"]] = Path(before.text[:shared], before.nodes[:shared], before.base)
        # Nodes numbered like the first word's own path stand on it; what is shared has its number already.
        nodes = [out[row["_run"]].nodes[d] if node == d + 1 and d < shared else node + before.base for d, node in enumerate(row["nodes"])]
        before = Path(row["last"], nodes, before.base + row["total"])
    return out


def number_prefixes(words: DataFrame) -> DataFrame:
    """``word, n`` with ``prefixes``, the nodes of depth 1 to its length, and ``id``, the last of them; ids order as words do."""
    runs = sorted_runs(words.select("word", "n"), F.col("word"))

    def step(batches: Iterator[pa.RecordBatch], carried: Path) -> Iterator[pa.RecordBatch]:
        path = carried.begin()
        for batch in batches:
            nodes = [path.to(word) for word in batch.column("word").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([n[-1] for n in nodes], pa.int64()), batch.column("word"), batch.column("n"), pa.array(nodes, pa.list_(pa.int64()))],
                ["id", "word", "n", "prefixes"])

    return scan(runs, paths_of_runs(runs, "word"), step, "id bigint, word string, n bigint, prefixes array<bigint>")


#: What a pair says: the word is cut there, or its place is skipped; a skip inside a run of one letter repeats the run's first.
CUT, SKIP, REPEATED = 0, 1, 2


def node_pairs(numbered: DataFrame) -> DataFrame:
    """``before, after, kind, id, n``: every cut and every skipped place of every word as a pair of nodes."""
    backward = numbered.select("id", "n", "prefixes", F.reverse("word").alias("drow"))
    runs = sorted_runs(backward, F.col("drow"))

    def step(batches: Iterator[pa.RecordBatch], carried: Path) -> Iterator[pa.RecordBatch]:
        path = carried.begin()
        parts: list[tuple[np.ndarray, ...]] = []
        held = 0

        def out() -> pa.RecordBatch:
            columns = [np.concatenate(x) for x in zip(*parts)]
            return pa.RecordBatch.from_arrays(list(map(pa.array, columns)), ["before", "after", "kind", "id", "n"])

        for batch in batches:
            rows = zip(*(batch.column(x).to_pylist() for x in ("id", "n", "prefixes", "drow")))
            for own, n, prefixes, drow in rows:
                size = len(drow)
                before = np.array([0, *prefixes], np.int64)
                after = np.array([0, *path.to(drow)], np.int64)[::-1]  # at i: what stands from place i on
                letters = np.frombuffer(drow[::-1].encode("utf-32-le"), np.uint32)
                repeated = np.append(False, letters[1:] == letters[:-1])
                kind = np.concatenate([np.full(size + 1, CUT, np.int8), np.where(repeated, REPEATED, SKIP).astype(np.int8)])
                pairs = 2 * size + 1
                parts.append((np.concatenate([before, before[:-1]]), np.concatenate([after, after[1:]]), kind,
                              np.full(pairs, own, np.int64), np.full(pairs, n, np.int64)))
                held += pairs
                if held >= PAIRS:
                    yield out()
                    parts, held = [], 0
        if parts:
            yield out()

    return scan(runs, paths_of_runs(runs, "drow"), step, "before bigint, after bigint, kind tinyint, id bigint, n bigint")


def near_words(pairs: DataFrame) -> DataFrame:
    """``id, n_near, best``: how many near words a word has, and the most frequent of them as ``(n, -id)``.

    A pair's words are collected: at most one per letter of the alphabet and one that is cut there.
    """
    groups = pairs.groupBy("before", "after").agg(
        F.count(F.lit(1)).alias("_size"), F.sort_array(F.collect_list(F.struct("n", (-F.col("id")).alias("minus_id"), "kind")), asc=False).alias("m"),
    ).where("_size > 1")
    counted = groups.select(
        "m", F.size(F.filter("m", lambda x: x["kind"] != CUT)).alias("_skips"), F.size(F.filter("m", lambda x: x["kind"] == SKIP)).alias("_first_skips"),
    )
    cut_there = F.size("m") - F.col("_skips")  # 0 or 1
    top, second = F.get("m", F.lit(0)), F.get("m", F.lit(1))

    def one(x):
        best = F.when(x["minus_id"] == top["minus_id"], second).otherwise(top)
        near = F.when(x["kind"] == CUT, F.col("_first_skips")).otherwise(
            F.col("_skips") - 1 + F.when(x["kind"] == SKIP, cut_there).otherwise(0))
        return F.struct((-x["minus_id"]).alias("id"), near.cast("bigint").alias("near"),
                        F.struct(best["n"].alias("n"), best["minus_id"].alias("minus_id")).alias("best"))

    each = counted.select(F.inline(F.transform("m", one)))
    return each.groupBy("id").agg(F.sum("near").alias("n_near"), F.max("best").alias("best"))


def roots(links: DataFrame) -> DataFrame:
    """``id, root`` from ``id, form``: each step doubles how far a word has gone; counts grow along the way, so it ends."""
    now = pin(links.select("id", F.col("form").alias("root")))
    while True:
        ahead = now.select(F.col("id").alias("_at"), F.col("root").alias("_next"))
        moved = pin(now.join(ahead, F.col("root") == F.col("_at"), "left").select("id", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")))
        now = moved.select("id", "root")
        if moved.where("_moved").limit(1).count() == 0:
            return now


def spelling_variants(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, ratio: int = RATIO,
                      every: int = EVERY) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word.

    Near words differ by one inserted, deleted or replaced letter. A word's form is the most frequent of
    them when it is at least ``ratio`` times as frequent; the root is where the forms lead to.
    """
    numbered = pin(number_prefixes(pin(count_words(docs, min_length, min_count, every))))
    words = numbered.select("id", "word", "n")
    near = pin(near_words(node_pairs(numbered)))
    joined = pin(words.join(near, "id", "left").select(
        "id", "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(F.col("best.n") >= ratio * F.col("n"), -F.col("best.minus_id")).alias("form_id"),
    ))
    to_root = roots(joined.where("form_id IS NOT NULL").select("id", F.col("form_id").alias("form")))
    forms = words.select(F.col("id").alias("form_id"), F.col("word").alias("form"), F.col("n").alias("form_n"))
    tops = words.select(F.col("id").alias("root"), F.col("word").alias("root_word"))
    return joined.join(to_root, "id", "left").join(forms, "form_id", "left").join(tops, "root", "left").select(
        "word", "form", F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n")


#: Every word hashed byte by byte and every deletion written out: another way to the same rows.
ORACLE = r"""
WITH RECURSIVE crc_table AS (
  SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
), runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM documents
), counted AS (
  SELECT doc_id, run, count(*) AS k FROM runs WHERE length(run) >= 6 GROUP BY 1, 2
), hashed AS (
  SELECT run, k, xor(list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, ''),
      lambda ch: CASE WHEN ord(ch) < 128 THEN [CAST(ord(ch) AS BIGINT)] ELSE [195::BIGINT, ord(ch) - 64] END))),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS h
  FROM counted, crc_table
), changed AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2) ELSE run END AS word, k FROM hashed
), words AS (
  SELECT word, CAST(sum(k) AS BIGINT) AS n FROM changed WHERE length(word) >= 6 GROUP BY 1 HAVING sum(k) >= 5
), places AS (
  SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words
), gaps AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS gap FROM places
), pairs AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM gaps a JOIN gaps b ON a.gap = b.gap AND a.i = b.i AND a.word <> b.word
  UNION SELECT g.word, w.word, w.n FROM gaps g JOIN words w ON g.gap = w.word
  UNION SELECT w.word, g.word, g.n FROM gaps g JOIN words w ON g.gap = w.word
), near AS (
  SELECT word, count(*) AS n_near, list({'n': other_n, 'w': other} ORDER BY other_n DESC, other)[1] AS best FROM pairs GROUP BY 1
), formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN best.n >= 5 * w.n THEN best.w END AS form, CASE WHEN best.n >= 5 * w.n THEN best.n END AS form_n
  FROM words w LEFT JOIN near USING (word)
), led AS (
  SELECT word, word AS root, form AS next FROM formed
  UNION ALL SELECT l.word, f.word, f.form FROM led l JOIN formed f ON l.next = f.word
)
SELECT f.word, f.form, l.root, f.n, CAST(f.n_near AS BIGINT) AS n_near, CAST(f.form_n AS BIGINT) AS form_n
FROM formed f JOIN led l ON l.word = f.word AND l.next IS NULL
"""
