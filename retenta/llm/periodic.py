"""Periodic runs of words, by a dictionary of basic factors.

For every power of two L the dictionary names the factors of L words: equal
names, equal words.  A name of length 2L is the pair of the names at a place and
L words on.  In a stretch of period q <= L, as long as the factor and q more
words, each factor comes again exactly q words on and no earlier, so the
successors that lie within a window of 2L words (at most L on) form progressions
of one step; places next to each other with the same step q are one progression
and propose the period q from their first word to the end of the last successor.
Two bounds make that whole: a run of length >= 3q shows up at each level with
q <= L and L + q <= length, the first of them among q <= L < 2q, and a factor
whose name is unique in its document takes no part in longer ones.

Documents are handled many at a time in numpy: names are made for all words of
an Arrow batch's slice at once, with document bounds, and only places whose
names recur in their document are carried to the next level.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

LEAST_LENGTH = 24    # words of a run, at least
LEAST_REPEATS = 3    # periods in a run, at least
SLICE = 1 << 18      # words named together; a longer document is a slice of its own


@dataclass(frozen=True)
class Run:
    """Words start to start + length - 1 have the smallest period `period`, and no neighbouring word goes on with it."""

    start: int
    length: int
    period: int


def _names(keys: np.ndarray) -> np.ndarray:
    return np.unique(keys, return_inverse=True)[1].astype(np.int64).ravel()


def _successors(name: np.ndarray, doc: np.ndarray, place: np.ndarray, last: int) -> tuple[np.ndarray, np.ndarray]:
    """For places in ascending order: the distance to the next equal name in the document (0: none), and whether the name recurs."""
    order = np.argsort(name * (last + 1) + doc, kind="stable")
    same = (name[order][1:] == name[order][:-1]) & (doc[order][1:] == doc[order][:-1])
    step = np.zeros(len(name), np.int64)
    step[order[:-1][same]] = (place[order][1:] - place[order][:-1])[same]
    again = np.zeros(len(name), bool)
    again[order[:-1][same]] = True
    again[order[1:][same]] = True
    return step, again


def _progressions(place: np.ndarray, doc: np.ndarray, step: np.ndarray, length: int) -> np.ndarray:
    """Rows (first place, end, period): neighbouring places with one step of at most `length`."""
    near = (step > 0) & (step <= length)
    place, doc, step = place[near], doc[near], step[near]
    if not len(place):
        return np.empty((0, 3), np.int64)
    cut = np.flatnonzero((place[1:] != place[:-1] + 1) | (step[1:] != step[:-1]) | (doc[1:] != doc[:-1])) + 1
    first, last = np.concatenate([[0], cut]), np.concatenate([cut, [len(place)]]) - 1
    return np.column_stack([place[first], place[last] + length + step[first], step[first]])


def _extend(found: np.ndarray, word: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Stretches moved out on both sides as long as the words q apart are equal, within [begin, end)."""
    a, z, q = found[:, 0].copy(), found[:, 1].copy(), found[:, 2]
    moving = np.arange(len(found))
    while len(moving):
        ok = (a[moving] > begin[moving]) & (word[np.maximum(a[moving] - 1, 0)] == word[np.maximum(a[moving] - 1, 0) + q[moving]])
        moving = moving[ok]
        a[moving] -= 1
    moving = np.arange(len(found))
    while len(moving):
        at = np.minimum(z[moving], len(word) - 1)
        moving = moving[(z[moving] < end[moving]) & (word[at] == word[at - q[moving]])]
        z[moving] += 1
    return np.column_stack([a, z, q])


def find_runs(word: np.ndarray, starts: np.ndarray, least_length: int = LEAST_LENGTH, least_repeats: int = LEAST_REPEATS) -> list[list[Run]]:
    """Runs of each document; document i has the word numbers word[starts[i]:starts[i + 1]].

    least_repeats is at least 3: with fewer, a run need not hold a factor as
    long as its period and that factor's successor.
    """
    if least_repeats < 3:
        raise ValueError("a run has three periods at least")
    sizes = np.diff(starts)
    docs = len(sizes)
    doc = np.repeat(np.arange(docs, dtype=np.int64), sizes)
    ends = starts[1:]
    place, name, length = np.arange(len(word), dtype=np.int64), _names(word), 1
    kept: set[tuple[int, int, int]] = set()
    while len(place):
        step, again = _successors(name, doc[place], place, docs)
        found = _progressions(place, doc[place], step, length)
        found = found[found[:, 1] - found[:, 0] >= np.maximum(least_length, least_repeats * found[:, 2])]
        if len(found):
            own = doc[found[:, 0]]
            kept.update(map(tuple, _extend(found, word, starts[own], ends[own]).tolist()))
        # longer factors begin, and L words on go on, with factors that recur
        place, name = place[again], name[again]
        other = np.searchsorted(place, place + length)
        fits = (other < len(place)) & (place + 2 * length <= ends[doc[place]])
        fits[fits] = place[other[fits]] == place[fits] + length
        if not fits.any():
            break
        top = int(name.max()) + 1
        place, name, length = place[fits], _names(name[fits] * top + name[other[fits]]), 2 * length
    out: list[list[Run]] = [[] for _ in range(docs)]
    for a, z, q in sorted(kept, key=lambda r: (r[0], r[2])):
        out[doc[a]].append(Run(a - int(starts[doc[a]]), z - a, q))
    return out


def collapse(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words without those that a run contains after its first period."""
    if not runs:
        return words
    gone = np.zeros(len(words), bool)
    for r in runs:
        gone[r.start + r.period:r.start + r.length] = True
    return [w for w, g in zip(words, gone.tolist()) if not g]


def strongest(runs: list[Run]) -> Run | None:
    """The run with the greatest length / period; ties go to the smaller start, then period."""
    best = None
    for r in runs:  # in order of start, then period
        if best is None or r.length * best.period > best.length * r.period:
            best = r
    return best


def repeated(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words of a planted document: of every tenth, by crc32 of its id, a tail that repeats itself."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def _slices(batch: pa.RecordBatch, plant: bool) -> Iterator[tuple[list, list[list[bytes]]]]:
    """Ids and words of a batch's rows, about SLICE words at a time."""
    ids, texts, total = [], [], 0
    for doc_id, text in zip(batch.column(0), batch.column(1)):
        own = doc_id.as_py()
        words = (text.as_py() or "").encode("utf-8", "surrogatepass").split()
        if ids and total + len(words) > SLICE:
            yield ids, texts
            ids, texts, total = [], [], 0
        ids.append(own)
        texts.append(repeated(words, own) if plant else words)
        total += len(words)
    if ids:
        yield ids, texts


def runs_of(texts: list[list[bytes]]) -> list[list[Run]]:
    number: dict[bytes, int] = {}
    word = np.fromiter((number.setdefault(w, len(number)) for words in texts for w in words), np.int64)
    return find_runs(word, np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64))


def periodic_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, start, length, period): one row per run of the texts as they are, by document in no order of rows.

    Null and empty texts have no runs; every row with a repeated id gives its own.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for ids, texts in _slices(b, False):
                rows = [(i, r.start, r.length, r.period) for i, runs in zip(ids, runs_of(texts)) for r in runs]
                yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], pa.int64()) for c in range(4)], ["doc_id", "start", "length", "period"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, start long, length long, period long")


def collapse_runs(docs: DataFrame) -> DataFrame:
    """docs with the words of every run after its first period dropped from text; texts without a run stay as they are, nulls null."""

    @F.pandas_udf("string")
    def shorter(text):
        import pandas as pd

        words = [(t or "").encode("utf-8", "surrogatepass").split() for t in text]
        found = [b" ".join(collapse(w, r)).decode("utf-8", "surrogatepass") if r else t for t, w, r in zip(text, words, runs_of(words))]
        return pd.Series(found, dtype=object)

    return docs.withColumn("text", shorter("text"))


_SCHEMA = ("doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
           "runs_sha256 string, collapsed_sha256 string")


def audit(docs: DataFrame) -> DataFrame:
    """One row per input row: its number of runs, the strongest run, and digests of all runs and of the collapsed words.

    Every tenth document (crc32 of its id) is searched with a planted
    repetition.  Words are cut at blanks, each whole text is read.  Null and
    empty texts have no words and no runs: four nulls and the digests of empty
    strings.  A null id plants nothing.  Repeated rows give equal rows, an empty
    table an empty one; other columns are ignored.  No shuffle: a document's
    words stay where it is read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for ids, texts in _slices(b, True):
                found = runs_of(texts)
                best = [strongest(r) for r in found]
                listed = [hashlib.sha256("".join(f"{x.start},{x.length},{x.period}\n" for x in r).encode()).hexdigest() for r in found]
                left = [hashlib.sha256(b" ".join(collapse(w, r))).hexdigest() for w, r in zip(texts, found)]
                columns = [ids, [len(r) for r in found], [x and x.start for x in best], [x and x.length for x in best],
                           [x and x.period for x in best], [x and 1000 * x.length // x.period for x in best]]
                yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns), pa.array(listed, pa.string()), pa.array(left, pa.string())],
                                                 [f.split()[0] for f in _SCHEMA.split(", ")])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _SCHEMA)


_CRC = """(4294967295 - list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT)),
  lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))))"""
SQL = f"""
WITH cut AS (
  SELECT doc_id, {_CRC} AS h, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS orig FROM documents
),
planted AS (SELECT *, len(orig) AS n, CASE WHEN len(orig) > 0 THEN (h // 10) % len(orig) END AS a FROM cut),
texts AS (
  SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0
    THEN list_transform(range(n), lambda i: orig[1 + CASE WHEN i >= a THEN a + (i - a) % (1 + (n - a) // (3 + (h // 10) % 8)) ELSE i END]) ELSE orig END AS words
  FROM planted
),
word AS (SELECT doc_id, n, u.i AS i, u.w AS w FROM (SELECT doc_id, n, unnest(list_transform(words, lambda x, j: {{'i': j - 1, 'w': x}})) AS u FROM texts)),
twice AS (
  SELECT x.doc_id, y.i - x.i AS q, x.i
  FROM word x JOIN word y ON x.doc_id = y.doc_id AND x.w = y.w AND y.i > x.i AND (y.i - x.i) * {LEAST_REPEATS} <= x.n
),
islands AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM twice),
stretches AS (
  SELECT doc_id, min(i) AS start, count(*) + q AS length, q FROM islands GROUP BY doc_id, q, island
  HAVING count(*) + q >= greatest({LEAST_LENGTH}, {LEAST_REPEATS} * q)
),
runs AS (SELECT doc_id, start, length, min(q) AS period FROM stretches GROUP BY doc_id, start, length),
listed AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS list
  FROM runs GROUP BY doc_id
),
best AS (
  SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length::DOUBLE / period DESC, start, period) = 1
),
gone AS (SELECT DISTINCT w.doc_id, w.i FROM word w JOIN runs r ON r.doc_id = w.doc_id AND w.i >= r.start + r.period AND w.i < r.start + r.length),
kept AS (
  SELECT w.doc_id, string_agg(w.w, ' ' ORDER BY w.i) AS text FROM word w LEFT JOIN gone g ON g.doc_id = w.doc_id AND g.i = w.i
  WHERE g.i IS NULL GROUP BY w.doc_id
)
SELECT t.doc_id, coalesce(l.n_runs, 0)::BIGINT AS n_runs, b.start::BIGINT AS start, b.length::BIGINT AS length, b.period::BIGINT AS period,
       (1000 * b.length // b.period)::BIGINT AS exponent_milli, sha256(coalesce(l.list, '')) AS runs_sha256, sha256(coalesce(k.text, '')) AS collapsed_sha256
FROM texts t LEFT JOIN listed l USING (doc_id) LEFT JOIN best b USING (doc_id) LEFT JOIN kept k USING (doc_id)
"""
