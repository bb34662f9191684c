"""Merkle manifest of a dataset, with nested-interval labels.

Every row is a leaf; leaves of one source form a tree whose nodes have up to
`fan` children, and the sources' roots form one more tree.  A node is labelled
with its level and the interval of leaf ranks it covers, so its ancestors are
the nodes of higher levels whose intervals contain its own: a join on (tree,
interval start / width of the level) with the containment as its condition.
The children of a parent whose intervals lie in the difference of the parent's
interval and a node's own are that node's siblings, those before it on the left
and those behind it on the right.

Levels shrink by the fan, each is written once, and no group holds more than
`fan` rows.  Leaves are dealt by ranges of their order, so a source with a large
share of all rows is spread over many tasks.  Proofs go down the tree:
each level's nodes take their parent's proof and put their own siblings in
front, so the long upper parts are made once for `fan` leaves.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window, functions as F

from retenta.llm.common import partitions, release, table

FAN = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DATASET = "0"  # name of the tree over the sources
PROOF = "array<struct<left:string,right:string>>"


def _digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def _field(value: Column) -> Column:
    """`-` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(doc_id: Column, source: Column, lang: Column, n_chars: Column, text: Column) -> Column:
    return _digest(*map(_field, (doc_id, source, lang, n_chars, text)))


def lower_ascii(text: Column) -> Column:
    return F.when(text.rlike("[A-Z]"), F.translate(text, UPPER, LOWER)).otherwise(text)


def is_tampered(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def tree_name(source: Column) -> Column:
    """The source as a key that is never null and sorts a null source first."""
    return F.when(source.isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), source))


def parents(nodes: DataFrame, fan: int, level: int) -> DataFrame:
    """(tree, n, lo, hi, digest, children) of `level`, from the nodes one level below; n is the tree's number of leaves."""
    run = F.floor(F.col("lo") / F.lit(fan ** level)).alias("run")
    return nodes.where(F.col("n") > fan ** (level - 1)).groupBy("tree", "n", run).agg(
        F.sort_array(F.collect_list(F.struct("lo", "hi", "digest"))).alias("children")).select(
        "tree", "n", F.col("children")[0]["lo"].alias("lo"), F.element_at("children", -1)["hi"].alias("hi"),
        _digest(F.array_join("children.digest", "")).alias("digest"), "children")


def build(leaves: DataFrame, fan: int = FAN, name: str = "merkle") -> list[DataFrame]:
    """All levels of the trees over (tree, n, lo, hi, digest, ...) leaves; each level above the leaves is a written table.

    Level L covers fan ** L ranks a node.  A tree ends where one node is left.
    The driver learns the largest number of leaves, nothing else.
    """
    largest = leaves.agg(F.max("n")).first()[0] or 0
    levels = [leaves]
    while fan ** (len(levels) - 1) < largest:
        levels.append(table(parents(levels[-1], fan, len(levels)), f"{name}-{len(levels)}"))
    return levels


def tops(levels: list[DataFrame], fan: int = FAN) -> DataFrame:
    """(tree, digest): the one node that is left of each tree."""
    found = [nodes.where((F.col("n") <= fan ** at) & (F.col("n") > (fan ** (at - 1) if at else 0))).select("tree", "digest")
             for at, nodes in enumerate(levels)]
    return functools.reduce(DataFrame.unionByName, found)


def attach_ancestors(nodes: DataFrame, above: DataFrame, width: int) -> DataFrame:
    """nodes with the proof that their parents' proofs and their own siblings make.

    `above` has (tree, lo, hi, children, proof) of the level whose nodes cover
    `width` ranks; its columns that nodes lack are handed down.
    """
    a, b = nodes.alias("a"), above.alias("b")
    carried = [F.col(f"b.{c}") for c in above.columns if c not in nodes.columns and c not in ("proof", "children")]
    within = ((F.col("a.tree") == F.col("b.tree")) & (F.floor(F.col("a.lo") / F.lit(width)) == F.floor(F.col("b.lo") / F.lit(width)))
              & (F.col("a.lo") >= F.col("b.lo")) & (F.col("a.hi") <= F.col("b.hi")))
    before = F.filter("b.children", lambda c: c["hi"] <= F.col("a.lo"))
    behind = F.filter("b.children", lambda c: c["lo"] >= F.col("a.hi"))
    own = F.struct(F.array_join(F.transform(before, lambda c: c["digest"]), "").alias("left"),
                   F.array_join(F.transform(behind, lambda c: c["digest"]), "").alias("right"))
    return a.join(b, within).select("a.*", *carried, F.concat(F.array(own), F.col("b.proof")).alias("proof"))


def attach_proofs(levels: list[DataFrame], outer: DataFrame, fan: int = FAN) -> DataFrame:
    """The leaves with `proof`: left and right siblings of each level, lowest first, then the tree's own proof from `outer`.

    outer has one row a tree.  Top down: the node that a tree ends with takes its
    tree's row, every other node joins its parent.  Levels above the leaves are
    small and stay in the plan.
    """
    above = None
    for at in range(len(levels) - 1, -1, -1):
        last = (F.col("n") <= fan ** at) & (F.col("n") > (fan ** (at - 1) if at else 0))
        here = levels[at].where(last).join(outer, "tree")
        if above is not None:
            here = here.unionByName(attach_ancestors(levels[at].where(F.col("n") > fan ** at), above, fan ** (at + 1)))
        above = here
    return above


def fold(digest: Column, proof: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(proof, digest, lambda d, p: _digest(p["left"], d, p["right"]))


def proof_digest(proof: Column) -> Column:
    return _digest(F.array_join(F.flatten(F.transform(proof, lambda p: F.array(p["left"], p["right"]))), ""))


def ranked(rows: DataFrame, key: str, name: str) -> DataFrame:
    """rows of (tree, digest, ...) with n, lo and hi: their places along (key, digest) in their tree, nulls first.

    Rows are dealt in order, by range, and written with the number of their
    range; a row's place is its place in the range plus the rows of earlier
    ranges.  The last key only splits rows that are equal in all that counts.
    """
    dealt = rows.withColumn("_even", F.monotonically_increasing_id()).repartitionByRange(partitions(rows.sparkSession), "tree", key, "digest", "_even")
    placed = table(dealt.drop("_even").withColumn("_range", F.spark_partition_id()), name)
    tree = Window.partitionBy("tree")
    before = F.sum("c").over(tree.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    counts = placed.groupBy("tree", "_range").agg(F.count(F.lit(1)).alias("c")).select(
        "tree", "_range", F.sum("c").over(tree).alias("n"), F.coalesce(before, F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("tree", "_range").orderBy(key, "digest"))
    # written, so that its measured size decides whether it goes to the rows or the rows to it
    out = placed.withColumn("hi", inside).join(table(counts, f"{name}-counts"), ["tree", "_range"]).withColumn("hi", F.col("hi") + F.col("_before"))
    return out.withColumn("lo", F.col("hi") - 1).drop("_range", "_before")


def hashed(docs: DataFrame) -> DataFrame:
    """(tree, doc_id, digest, other) for every row: its leaf, and the leaf of its tampered form (null where it is not tampered)."""
    cols = [F.col(f"`{c}`") for c in FIELDS]
    changed = F.when(is_tampered(F.col("doc_id")), leaf_digest(*cols[:-1], lower_ascii(F.col("text"))))
    return docs.select(tree_name(F.col("source")).alias("tree"), F.col("doc_id").cast("long").alias("doc_id"),
                       leaf_digest(*cols).alias("digest"), changed.alias("other"))


def forest(docs: DataFrame, fan: int = FAN) -> tuple[list[DataFrame], list[DataFrame]]:
    """Levels of the sources' trees, and levels of the tree over the sources.

    docs needs the columns of FIELDS; more are ignored.
    """
    leaves = table(hashed(docs), "merkle-leaves")  # the texts are read and hashed once, not again to find the ranges
    places = table(ranked(leaves, "doc_id", "merkle-rows"), "merkle-ranked")
    release(leaves)
    inner = build(places, fan, "merkle-node")
    over = table(tops(inner, fan).select(F.lit(DATASET).alias("tree"), F.col("tree").alias("member"), "digest"), "merkle-roots")
    outer = build(table(ranked(over, "member", "merkle-sources"), "merkle-subroots"), fan, "merkle-top")
    return inner, outer


def manifest(docs: DataFrame, fan: int = FAN) -> DataFrame:
    """(scope, source_tree, level, lo, hi, digest): every node, to be kept beside the data.

    scope is `source` or `dataset`; source_tree is the source behind a `1`, or
    `0` for a null source (and for the tree over the sources).
    """
    inner, outer = forest(docs, fan)
    parts = [nodes.select(F.lit(scope).alias("scope"), F.col("tree").alias("source_tree"), F.lit(at).alias("level"), "lo", "hi", "digest")
             for scope, levels in (("source", inner), ("dataset", outer)) for at, nodes in enumerate(levels)]
    return functools.reduce(DataFrame.unionByName, parts)


def prove(docs: DataFrame, fan: int = FAN) -> DataFrame:
    """(tree, doc_id, digest, other, n, lo, hi, subroot, root, proof) for every row; proof is ARRAY<STRUCT<left, right>>."""
    inner, outer = forest(docs, fan)
    top = tops(outer, fan).select("tree", F.col("digest").alias("root"), F.array().cast(PROOF).alias("proof"))
    sources = attach_proofs(outer, top, fan)
    up = sources.select(F.col("member").alias("tree"), F.col("digest").alias("subroot"), "root", "proof")
    return attach_proofs(inner, table(up, "merkle-up"), fan)


def audit(docs: DataFrame, fan: int = FAN) -> DataFrame:
    """One row per input row: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    A row whose id's crc32 is divisible by 5 is folded from the leaf of its
    tampered form (A-Z of the text lower-cased), any other from its own leaf,
    with the siblings of the untampered data.  verified tells whether that
    gives the root, so it stays true where tampering changes nothing (null text,
    no capital).  Null ids come first in their source and are never tampered
    with; rows that repeat an id are leaves of their own, ordered by their digest;
    a null source is a source.  An empty table gives an empty
    one; other columns are ignored.
    """
    folded = fold(F.coalesce("other", "digest"), F.col("proof"))
    found = prove(docs, fan).select("doc_id", F.col("digest").alias("leaf"), "subroot", "root",
                                    proof_digest(F.col("proof")).alias("proof_sha256"), folded.alias("folded_root"))
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))


_CRC = """(4294967295 - list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT)),
  lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))))"""
_FIELD = "coalesce(strlen({0}::VARCHAR) || ':' || {0}::VARCHAR, '-')"


def _leaf_sql(text: str) -> str:
    return "sha256(" + " || ".join(_FIELD.format(c) for c in (*FIELDS[:-1], text)) + ")"


SQL = f"""
WITH RECURSIVE hashed AS (
  SELECT doc_id, source, {_leaf_sql("text")} AS leaf, {_CRC} % 5 = 0 AS changed,
         {_leaf_sql(f"translate(text, '{UPPER}', '{LOWER}')")} AS lowered
  FROM documents
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank, count(*) OVER (PARTITION BY source) AS n FROM hashed
),
inner_nodes AS (
  SELECT source, n, 0 AS level, rank AS idx, leaf AS digest FROM placed
  UNION ALL
  SELECT source, (n + {FAN - 1}) // {FAN}, level + 1, idx // {FAN}, sha256(string_agg(digest, '' ORDER BY idx))
  FROM inner_nodes WHERE n > 1 GROUP BY source, n, level, idx // {FAN}
),
subroots AS (
  SELECT source, digest AS subroot, row_number() OVER (ORDER BY source COLLATE "C" NULLS FIRST) - 1 AS rank, count(*) OVER () AS n FROM inner_nodes WHERE n = 1
),
outer_nodes AS (
  SELECT n, 0 AS level, rank AS idx, subroot AS digest FROM subroots
  UNION ALL
  SELECT (n + {FAN - 1}) // {FAN}, level + 1, idx // {FAN}, sha256(string_agg(digest, '' ORDER BY idx))
  FROM outer_nodes WHERE n > 1 GROUP BY n, level, idx // {FAN}
),
root AS (SELECT digest AS root FROM outer_nodes WHERE n = 1),
depths AS (SELECT source, max(level) AS depth FROM inner_nodes GROUP BY source),
steps AS (
  SELECT p.doc_id, p.source, p.rank AS lrank, d.level, s.idx AS own, d.idx, d.digest
  FROM placed p
  JOIN (SELECT DISTINCT source, level, idx FROM inner_nodes WHERE n > 1) s ON s.source IS NOT DISTINCT FROM p.source AND s.idx = p.rank // ({FAN} ** s.level)::BIGINT
  JOIN inner_nodes d ON d.source IS NOT DISTINCT FROM p.source AND d.level = s.level AND d.idx // {FAN} = s.idx // {FAN}
  UNION ALL
  SELECT p.doc_id, p.source, p.rank, depth + d.level, s.idx, d.idx, d.digest
  FROM placed p
  JOIN depths e ON e.source IS NOT DISTINCT FROM p.source
  JOIN subroots r ON r.source IS NOT DISTINCT FROM p.source
  JOIN (SELECT DISTINCT level, idx FROM outer_nodes WHERE n > 1) s ON s.idx = r.rank // ({FAN} ** s.level)::BIGINT
  JOIN outer_nodes d ON d.level = s.level AND d.idx // {FAN} = s.idx // {FAN}
),
sides AS (
  SELECT source, lrank, level, coalesce(string_agg(digest, '' ORDER BY idx) FILTER (WHERE idx < own), '') AS lefts,
         coalesce(string_agg(digest, '' ORDER BY idx) FILTER (WHERE idx > own), '') AS rights
  FROM steps GROUP BY source, lrank, level
),
proofs AS (SELECT source, lrank, sha256(string_agg(lefts || rights, '' ORDER BY level)) AS proof, count(*) AS height FROM sides GROUP BY source, lrank),
folds AS (
  SELECT source, rank, 0 AS level, CASE WHEN changed THEN lowered ELSE leaf END AS digest FROM placed
  UNION ALL
  SELECT f.source, f.rank, f.level + 1, sha256(s.lefts || f.digest || s.rights)
  FROM folds f JOIN sides s ON s.source IS NOT DISTINCT FROM f.source AND s.lrank = f.rank AND s.level = f.level
)
SELECT p.doc_id, p.leaf, r.subroot, root.root, coalesce(q.proof, sha256('')) AS proof_sha256, f.digest AS folded_root, f.digest = root.root AS verified
FROM placed p
JOIN subroots r ON r.source IS NOT DISTINCT FROM p.source
CROSS JOIN root
LEFT JOIN proofs q ON q.source IS NOT DISTINCT FROM p.source AND q.lrank = p.rank
JOIN folds f ON f.source IS NOT DISTINCT FROM p.source AND f.rank = p.rank AND f.level = coalesce(q.height, 0)
"""
