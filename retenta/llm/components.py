"""Connected components of a link table by alternating large and small stars.

Each round is one Spark job that writes a new link table to the shared folder;
the driver sees only a row count and a checksum.  No neighbour list is ever
gathered: a star's centre is a minimum, and links meet it through a join, whose
hot keys AQE splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from retenta.llm.common import release, table


def _signature(links: DataFrame) -> tuple:
    h = F.xxhash64("a", "b")
    return tuple(links.agg(F.count(F.lit(1)), F.sum(h.cast("decimal(38,0)")), F.bit_xor(h)).first())


def components(links: DataFrame) -> DataFrame:
    """(a, b) links of long ids, in any order and with repeats -> (id, component).

    component is the smallest id reachable; ids without a link to another id
    do not appear.  Rows with a null end are ignored.  An empty table gives an
    empty one.
    """
    real = links.where(F.col("a") != F.col("b"))  # null ends fail the condition too
    now = table(real.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before, sign = None, _signature(now)
    while sign != before and sign[0]:
        near = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = near.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = near.where(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        ends = F.explode(F.array(F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b"))))
        small = large.join(low, "a").select(ends.alias("e")).select("e.a", "e.b").where(F.col("a") != F.col("b")).distinct()
        new = table(small, "links")
        release(now)
        now, before, sign = new, sign, _signature(new)
    roots = now.select(F.col("b").alias("id")).distinct().select("id", F.col("id").alias("component"))
    return now.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(roots)
