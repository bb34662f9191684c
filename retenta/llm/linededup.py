"""Line deduplication by a log-template tree, in DataFrame functions alone.

The tree has a fixed depth: a line goes by its number of tokens, then by its
leading tokens, to a leaf; tokens with a digit are variable fields from the
start.  In a leaf, a token is constant if several documents have it at that
place; the other fields are variable.  Lines of one leaf with the same
constants share a template when enough of their tokens are constant; any other
line is its own template.  A template that recurs across documents stays in the
document with the smallest id and is dropped from all others.

Work on texts is kept small: lines are first reduced to hashes, and only leaves
that hold different lines of different documents need tokens again, once for
each distinct line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from retenta.llm.common import table

LEAST_TOKENS = 3      # shorter lines have no template: they recur as they are, or (the SQL twin's rule) always stay
LEADING = 3           # leading tokens on the way to a leaf
CONSTANT_TENTHS = 8   # tenths of a line's tokens that a template must fix
FIELD = "<*>"
_WITH_DIGIT = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9]*+[0-9][^\x20\x09-\x0D]*+"


def _masked(line: Column) -> Column:
    """The line's tokens, joined by single spaces, each token with a digit as a variable field."""
    bare = F.trim(line, F.lit(" \t\n\x0b\f\r"))
    uneven = F.lit(False)
    for gap in ("  ", "\t", "\x0b", "\f", "\r"):  # looked for as bytes; few lines need the pattern
        uneven = uneven | F.contains(line, F.lit(gap))
    plain = F.when(uneven, F.regexp_replace(bare, r"[\x20\x09-\x0D]{2,}|[\x09-\x0D]", " ")).otherwise(bare)
    return F.when(line.rlike("[0-9]"), F.regexp_replace(plain, _WITH_DIGIT, FIELD)).otherwise(plain)


def _two_hashes(*cols: Column) -> tuple[Column, Column]:
    """128 bits, so that no two of very many lines are taken for one."""
    return F.xxhash64(*cols), F.xxhash64(F.lit(7), *cols)


def _lines(docs: DataFrame, short: bool) -> DataFrame:
    """(doc_id, row, pos, leaf, h1, h2) of every line; row tells rows of one id apart.

    Short lines have no leaf; with `short` they are hashed as they stand, digits
    and all.  Lines that always stay have null hashes and are left out by the reader: a
    filter here would be pushed below the patterns and run them again.
    """
    lines = docs.where(F.col("doc_id").isNotNull()).select(
        "doc_id", F.xxhash64("text").alias("row"), F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    bare = [F.trim("line", F.lit(" \t\n\x0b\f\r")).alias("bare")] if short else []
    cut = lines.select("doc_id", "row", "pos", _masked(F.col("line")).alias("whole"), *bare)
    n = F.octet_length("whole") - F.octet_length(F.replace("whole", F.lit(" "), F.lit(""))) + 1
    long = (F.col("whole") != "") & (n >= LEAST_TOKENS)
    h1, h2 = _two_hashes(F.when(long, F.col("whole")).otherwise(F.col("bare")) if short else F.col("whole"))
    hashed = F.col("whole") != "" if short else long
    leaf = F.xxhash64(n, F.substring_index("whole", " ", LEADING))
    return cut.select("doc_id", "row", "pos", F.when(long, leaf).alias("leaf"), F.when(hashed, h1).alias("h1"), F.when(hashed, h2).alias("h2"))


def _line(texts: DataFrame, element: Column) -> Column:
    """The line in an element of texts' arrays, which hold lines, or structures of a line and (in the first) the row's other columns."""
    return element["line"] if isinstance(texts.schema["lines"].dataType.elementType, StructType) else element


def _templates(texts: DataFrame, distinct: DataFrame) -> DataFrame:
    """(leaf, h1, h2, g1, g2, lo, hi): the template of each line that has one with variable fields, or could have.

    Only leaves that hold different lines of different documents are looked at.
    """
    mixed = distinct.groupBy("leaf").agg(F.count(F.lit(1)).alias("kinds"), F.min("lo").alias("a"), F.max("hi").alias("z"))
    wanted = distinct.join(mixed.where((F.col("kinds") > 1) & (F.col("a") != F.col("z"))).select("leaf"), "leaf", "left_semi")
    by_doc = wanted.groupBy(F.col("first.doc_id").alias("doc_id"), F.col("first.row").alias("row")).agg(
        F.collect_list(F.struct(F.col("first.pos").alias("pos"), "leaf", "h1", "h2", "lo", "hi")).alias("wanted"))  # a document's own lines
    own = texts.select("doc_id", "row", "lines").join(by_doc, ["doc_id", "row"]).select(
        F.explode(F.transform("wanted", lambda w: F.struct(w.alias("w"), _line(texts, F.get("lines", w["pos"])).alias("line")))).alias("own"))
    cut = own.select("own.w.h1", "own.w.h2", F.struct("own.w.leaf", "own.w.lo", "own.w.hi", _masked(F.col("own.line")).alias("whole")).alias("one"))
    # rows that repeat a document bring its lines again; the readers below share this shuffle, so all name the same non-null columns
    cut = cut.where("h1 is not null and h2 is not null")
    once = cut.groupBy("h1", "h2").agg(F.first("one").alias("one")).select("h1", "h2", "one.leaf", "one.lo", "one.hi", F.split("one.whole", " ").alias("tokens"))
    # a leaf's leading tokens are constant: all its lines have them, and they come from several documents
    place = F.explode(F.slice(F.transform("tokens", lambda t, i: F.when(t != FIELD, F.xxhash64(i, t))), LEADING + 1, F.size("tokens"))).alias("at")
    held = once.select("leaf", "lo", "hi", place).where("at is not null").groupBy("leaf", "at").agg(F.min("lo").alias("a"), F.max("hi").alias("z"))
    constant = held.where(F.col("a") != F.col("z")).select("leaf", "at")
    # a template is the set of its constants, as an exclusive or of two hashes of each
    shapes = once.select("leaf", "h1", "h2", place).join(constant, ["leaf", "at"]).groupBy("h1", "h2").agg(
        F.count(F.lit(1)).alias("later"), F.bit_xor("at").alias("g1"), F.bit_xor(F.xxhash64(F.lit(7), "at")).alias("g2"))
    leading = F.size(F.filter(F.slice("tokens", 1, LEADING), lambda t: t != FIELD))
    met = once.join(shapes, ["h1", "h2"], "left").withColumn("fixed", leading + F.coalesce("later", F.lit(0)))
    return met.where(F.col("fixed") * 10 >= F.size("tokens") * CONSTANT_TENTHS).select(
        "leaf", "h1", "h2", F.coalesce("g1", F.lit(0)).alias("g1"), F.coalesce("g2", F.lit(0)).alias("g2"), "lo", "hi")


def recurring_lines(docs: DataFrame, texts: DataFrame, short: bool = False) -> DataFrame:
    """(doc_id, row, dropped): places of the lines that recur, for every document that loses some.

    texts holds (doc_id, row, lines) of every document that has an id.  A line
    recurs as it is, or by its template; its home is the smallest document of both.
    """
    lines = table(_lines(docs, short), "lines").where("h1 is not null")
    distinct = table(lines.groupBy("leaf", "h1", "h2").agg(
        F.max("doc_id").alias("hi"), F.min(F.struct("doc_id", "row", "pos")).alias("first")), "distinct-lines").withColumn("lo", F.col("first.doc_id"))
    alike = distinct.where(F.col("lo") != F.col("hi")).select("h1", "h2", F.col("lo").alias("home"))
    known = _templates(texts, distinct)
    groups = known.groupBy("leaf", "g1", "g2").agg(F.min("lo").alias("home"), F.max("hi").alias("last"))
    shaped = known.join(groups.where(F.col("home") != F.col("last")), ["leaf", "g1", "g2"]).select("h1", "h2", "home")
    again = alike.unionByName(shaped).groupBy("h1", "h2").agg(F.min("home").alias("home"))
    gone = lines.join(again, ["h1", "h2"]).where(F.col("doc_id") > F.col("home"))  # equal lines are in one leaf
    return gone.groupBy("doc_id", "row").agg(F.collect_set("pos").alias("dropped"))


def drop_lines(docs: DataFrame, short: bool = False) -> DataFrame:
    """docs with their recurring lines dropped, and n_lines and n_dropped (both replaced if they exist).

    All rows and other columns stay; a text that loses all its lines is empty.
    Null texts stay null (0 lines), rows without doc_id stay whole and count
    for nothing.  Lines repeated within one document only do not recur.  Rows
    that repeat an id are one document.  Lines of fewer than LEAST_TOKENS
    blank-separated tokens, such as all lines in scripts without blanks, stay
    unless `short` is set: then they are dropped where they recur exactly.

    Texts are dealt by document once, as arrays of lines, for the tokens of
    look-alike lines and for the drop alike: both joins read one shuffle.
    """
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text", "n_lines", "n_dropped")]
    lines = F.split("text", "\n")
    if others:  # within the arrays, so that both joins ask for the same columns; no name of another column can clash
        rest = F.struct(*others)
        lines = F.transform(F.coalesce(lines, F.array(F.lit(None).cast("string"))), lambda line, i: F.struct(line.alias("line"), F.when(i == 0, rest).alias("rest")))
    texts = docs.select("doc_id", F.xxhash64("text").alias("row"), lines.alias("lines"))
    named = texts.where(F.col("doc_id").isNotNull())
    met = named.join(recurring_lines(docs.select("doc_id", "text"), named, short), ["doc_id", "row"], "left")
    nameless = texts.where(F.col("doc_id").isNull()).withColumn("dropped", F.lit(None).cast("array<int>"))
    every = met.unionByName(nameless)
    kept = F.when(F.col("dropped").isNull(), F.col("lines")).otherwise(F.filter("lines", lambda line, i: ~F.array_contains("dropped", i)))
    none = F.col("lines").isNull()
    if others:
        none = F.col("lines")[0]["line"].isNull()
        kept = F.when(~none, F.transform(kept, lambda e: e["line"]))
        every = every.withColumn("rest", F.col("lines")[0]["rest"])
    return every.select(
        "doc_id", F.array_join(kept, "\n").alias("text"), *(["rest.*"] if others else []),
        F.when(none, 0).otherwise(F.size("lines")).cast("long").alias("n_lines"),
        F.when(F.col("dropped").isNull(), 0).otherwise(F.size("dropped")).cast("long").alias("n_dropped"))


SQL = f"""
WITH lines AS (
  SELECT doc_id, u.p AS pos, u.line AS line
  FROM (SELECT doc_id, unnest(list_transform(string_split(text, chr(10)), lambda x, i: {{'p': i, 'line': x}})) AS u FROM documents WHERE text IS NOT NULL)
),
cut AS (
  SELECT *, list_transform(list_filter(string_split_regex(line, '[\\x20\\x09-\\x0D]+'), lambda t: t <> ''),
                           lambda t: CASE WHEN regexp_matches(t, '[0-9]') THEN '{FIELD}' ELSE t END) AS tokens
  FROM lines
),
keyed AS (SELECT *, len(tokens) AS n, list_slice(tokens, 1, {LEADING}) AS head, array_to_string(tokens, ' ') AS whole FROM cut WHERE len(tokens) >= {LEAST_TOKENS}),
parts AS (
  SELECT DISTINCT doc_id, n, head, whole, u.p AS p, u.t AS token
  FROM (SELECT doc_id, n, head, whole, unnest(list_transform(tokens, lambda x, i: {{'p': i, 't': x}})) AS u FROM keyed)
),
fixed AS (
  SELECT n, head, p, token FROM parts WHERE token <> '{FIELD}' GROUP BY ALL HAVING min(doc_id) <> max(doc_id)
),
shapes AS (
  SELECT n, head, whole, count(f.token) AS constants, string_agg(coalesce(f.token, '{FIELD}'), ' ' ORDER BY p) AS shape
  FROM (SELECT DISTINCT n, head, whole, p, token FROM parts) q LEFT JOIN fixed f USING (n, head, p, token) GROUP BY n, head, whole
),
named AS (
  SELECT k.doc_id, k.pos, n, head, CASE WHEN constants * 10 >= n * {CONSTANT_TENTHS} THEN shape ELSE 'line ' || whole END AS template
  FROM keyed k JOIN shapes USING (n, head, whole)
),
homes AS (SELECT n, head, template, min(doc_id) AS home FROM named GROUP BY ALL),
gone AS (SELECT DISTINCT doc_id, pos FROM named JOIN homes USING (n, head, template) WHERE doc_id > home),
kept AS (
  SELECT doc_id, count(*) AS n_lines, count(gone.pos) AS n_dropped, string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE gone.pos IS NULL) AS text
  FROM lines LEFT JOIN gone USING (doc_id, pos) GROUP BY doc_id
)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_dropped, 0)::BIGINT AS n_dropped
FROM documents d LEFT JOIN kept k USING (doc_id)
"""
