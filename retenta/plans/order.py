"""Exact global order without a single-task window.

`Window.orderBy` with no partition runs in one task.  Here rows are put into
value bins first, using approximate quantiles as cut points (exact results do
not depend on how good the cuts are), running totals are taken inside each
bin, and the totals of earlier bins come from a small table of at most a few
bins per group.

A value repeated so often that it fills several cut points gets a bin of its
own, split further by the tie-break column in proportion to its share, so one
score shared by a third of all rows still spreads over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

BIN, TIE_BIN, CUTS = "_bin", "_tie_bin", "_cuts"


def bin_count(df: DataFrame) -> int:
    """Twice the session's shuffle partitions, so a bin is about half a partition."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(16, 2 * parts)


def cut_points(col: Column, n: int) -> Column:
    """n - 1 approximate quantiles (aggregate; state bounded by the accuracy)."""
    return F.percentile_approx(col, [i / n for i in range(1, n)], F.lit(max(1000, 4 * n)))


def with_positions(df: DataFrame, searches: Sequence[tuple[str, str, str]], n_cuts: int,
                   upto: Sequence[tuple[str, str, str]] = ()) -> DataFrame:
    """Binary search: for each (key, cuts array, out) add how many cuts are < key (<= key in `upto`).

    One projection per halving step, so the search stays in generated code and
    its length is log2 of the number of cuts.  A step names the place found so
    far three times, so a plan that wrote the place out in terms of its inputs
    (planning does, for a join on it) would treble with every step; the places
    leave through a generator, which ends that.
    """
    step = 1
    while step * 2 <= n_cuts:
        step *= 2
    found = {out: f"_search{out}" for _, _, out in (*searches, *upto)}
    if not found:
        return df
    df = df.withColumns({at: F.lit(0) for at in found.values()})
    while step:
        moves = {}
        for i, (key, cuts, out) in enumerate((*searches, *upto)):
            place = F.col(found[out])
            at = F.get(F.col(cuts), place + (step - 1))
            passed = at < F.col(key) if i < len(searches) else at <= F.col(key)
            moves[found[out]] = F.when(passed, place + step).otherwise(place)
        df = df.withColumns(moves)
        step //= 2
    places = F.struct(*[F.col(at).alias(out) for out, at in found.items()])
    return df.select("*", F.inline(F.array(places))).drop(*found.values())


def _is_text(df: DataFrame, name: str) -> bool:
    return df.schema[name].dataType.typeName() in ("string", "char", "varchar")


def assign_bins(df: DataFrame, key: str, tie: str | None = None, bins: int | None = None) -> DataFrame:
    """Add `_bin` and `_tie_bin`, which together partition and order (key, tie)."""
    n = bins or bin_count(df)
    fields = [cut_points(F.col(key), n).alias("k")]
    if tie:
        fields.append(cut_points(F.col(tie), n).alias("t"))
    cuts = df.agg(F.struct(*fields).alias(CUTS)).scalar()
    searches = [(key, f"{CUTS}.k", "_below")]
    if tie:
        searches.append((tie, f"{CUTS}.t", "_tie_below"))
    df = with_positions(df.withColumn(CUTS, cuts), searches, n - 1, upto=[(key, f"{CUTS}.k", "_upto")])
    same = F.col("_upto") - F.col("_below")
    place = F.when(F.col(key).isNull(), F.lit(-1)).otherwise(2 * F.col("_below") + (same > 0).cast("int"))
    # never NULL, and declared so by coalesce: a join on the bins then adds no
    # not-NULL filter, which would be pushed through every search step below
    df = df.withColumn(BIN, F.coalesce(place, F.lit(-1)))
    tie_bin = F.lit(0)
    if tie:
        # a value filling m cuts holds about m / n of the rows: m tie bins keep them even
        tie_bin = F.when(F.col(key).isNull(), F.col("_tie_below")).when(
            same > 1, F.floor(F.col("_tie_below") * same / F.lit(n)).cast("int")).otherwise(F.lit(0))
    return df.withColumn(TIE_BIN, F.coalesce(tie_bin, F.lit(0))).drop(CUTS, "_below", "_upto", "_tie_below")


def running_totals(
    df: DataFrame,
    key: str,
    totals: dict[str, Column],
    *,
    tie: str | None = None,
    by: Sequence[str] = (),
    descending: bool = False,
    last_order: Sequence[str] = (),
    bins: int | None = None,
) -> DataFrame:
    """Inclusive running sum of each expression in `totals` along (key, tie) per group.

    Rows with equal (key, tie) need `last_order` columns to make the order
    total.  Groups in `by` must not be NULL.
    """
    by = list(by)
    binned = assign_bins(df, key, tie, bins)
    binned = binned.withColumns({f"_in_{n}": c for n, c in totals.items()})
    slot = [*by, BIN, TIE_BIN]
    per_bin = binned.groupBy(*slot).agg(*[F.sum(f"_in_{n}").alias(f"_sum_{n}") for n in totals])
    bin_order = F.col(BIN).desc() if descending else F.col(BIN).asc()
    earlier = W.partitionBy(*by).orderBy(bin_order, F.col(TIE_BIN).asc()).rowsBetween(W.unboundedPreceding, -1)
    offsets = per_bin.select(
        *slot,
        *[F.coalesce(F.sum(f"_sum_{n}").over(earlier), F.lit(0)).alias(f"_off_{n}") for n in totals],
    )
    if not by:
        # about four rows per bin at most: 2 per cut, the tie bins of crowded values, the NULLs
        offsets = F.broadcast(offsets)
    key_order = F.col(key).desc() if descending else F.col(key).asc()
    order = [key_order, *([F.col(tie).asc()] if tie else []), *[F.col(c).asc() for c in last_order]]
    inside = W.partitionBy(*slot).orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    out = binned.join(offsets, slot)
    out = out.withColumns({n: F.sum(f"_in_{n}").over(inside) + F.col(f"_off_{n}") for n in totals})
    return out.drop(BIN, TIE_BIN, *[f"_in_{n}" for n in totals], *[f"_off_{n}" for n in totals])


def with_rank(
    df: DataFrame,
    key: str,
    tie: str,
    *,
    by: Sequence[str] = (),
    descending: bool = False,
    name: str = "rank",
    bins: int | None = None,
) -> DataFrame:
    """Row number 1..n along (key, tie) per group; text ties order by hash, then text."""
    last: Sequence[str] = ()
    work, tie_col = df, tie
    if _is_text(df, tie):
        work, tie_col, last = df.withColumn("_tie", F.xxhash64(tie)), "_tie", (tie,)
    out = running_totals(
        work, key, {name: F.lit(1).cast("long")},
        tie=tie_col, by=by, descending=descending, last_order=last, bins=bins,
    )
    return out.drop("_tie") if tie_col == "_tie" else out


def average_ranks(df: DataFrame, value: str, *, by: Sequence[str] = (), carry: dict[str, Column] | None = None,
                  bins: int | None = None) -> DataFrame:
    """One row per (group, value): count, average rank, and the `carry` sums.

    Ties collapse to one row before anything is ordered, so no key is hot.
    """
    by = list(by)
    runs = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(
        F.count(F.lit(1)).alias("n"), *[c.alias(k) for k, c in (carry or {}).items()]
    )
    cum = running_totals(runs, value, {"_cum": F.col("n")}, by=by, bins=bins)
    return cum.withColumn("avg_rank", F.col("_cum") - (F.col("n") - 1) / F.lit(2.0)).drop("_cum")


def number_rows(df: DataFrame, keys: Sequence[str], by: Sequence[str], name: str) -> DataFrame:
    """df with its row number from 1 along the keys in each group of `by`, for keys of any type, nulls first.

    Rows are dealt by ranges of (by, keys) and written with the number of their
    range; a row's number is its place in the range after the rows of earlier
    ranges.  Groups in `by` must not be NULL; equal rows are numbered in any order.
    """
    from retenta.session import settle

    by, keys = list(by), list(keys)
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = settle(df.repartitionByRange(parts, *by, *keys).withColumn("_range", F.spark_partition_id()), "numbered")
    earlier = W.partitionBy(*by).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    before = dealt.groupBy(*by, "_range").agg(F.count(F.lit(1)).alias("_c")).select(*by, "_range", F.coalesce(F.sum("_c").over(earlier), F.lit(0)).alias("_before"))
    inside = F.row_number().over(W.partitionBy(*by, "_range").orderBy(*keys))
    out = dealt.withColumn(name, inside).join(before, [*by, "_range"]).withColumn(name, F.col(name) + F.col("_before"))
    return out.drop("_range", "_before")
