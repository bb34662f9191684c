"""Feature transforms with fitted parameters: scaling, encoding, interactions, selection, PCA."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field
from itertools import combinations

from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector, SparseVector, VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from retenta.functions.expr import ratio
from retenta.operators.quality import apply_winsor, fit_winsor, mode_value, numeric_columns, text_columns
from retenta.operators.timefeat import fit_reference_date, rfm_features
from retenta.params import OutlierParams, Transactions
from retenta.plans.order import number_rows
from retenta.plans.quantiles import fit_quantiles
from retenta.session import settle

MAX_CATEGORIES = 1000


@dataclass
class NumericFit:
    """impute -> winsorise -> scale, per column."""

    fill: dict[str, float]
    bounds: dict[str, tuple[float, float]]
    centre: dict[str, float]
    width: dict[str, float]


def fit_numeric(df: DataFrame, cols: Sequence[str], impute: str = "median", scale: str = "standard",
                params: OutlierParams = OutlierParams(), winsor: bool = True) -> NumericFit:
    """Each step is fitted on the output of the step before; standard scaling uses the population deviation."""
    if impute == "median":
        fill = {c: q[0] for c, q in fit_quantiles(df, cols, [0.5]).items()}
    elif impute == "mean":
        one = df.agg(*[F.avg(c).alias(c) for c in cols]).first()
        fill = {c: one[c] for c in cols}
    else:
        fill = {c: 0.0 for c in cols}
    filled = _fill(df, fill)
    bounds = fit_winsor(filled, cols, params) if winsor else {}
    ready = apply_winsor(filled, bounds)
    if scale == "robust":
        q = fit_quantiles(ready, cols, [0.25, 0.5, 0.75])
        centre, width = {c: v[1] for c, v in q.items()}, {c: v[2] - v[0] for c, v in q.items()}
    else:
        mid, wide = (F.avg, F.stddev_pop) if scale == "standard" else (F.min, lambda c: F.max(c) - F.min(c))
        one = ready.agg(*[x for c in cols for x in (mid(c).alias(f"{c}_m"), wide(F.col(c)).alias(f"{c}_w"))]).first()
        centre, width = {c: one[f"{c}_m"] for c in cols}, {c: one[f"{c}_w"] for c in cols}
    return NumericFit(fill, bounds, centre, {c: w if w else 1.0 for c, w in width.items()})


def _fill(df: DataFrame, fill: dict[str, float]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(v)) for c, v in fill.items()})


def apply_numeric(df: DataFrame, fit: NumericFit) -> DataFrame:
    df = apply_winsor(_fill(df, fit.fill), {c: tuple(b) for c, b in fit.bounds.items()})
    return df.withColumns({c: (F.col(c) - F.lit(fit.centre[c])) / F.lit(fit.width[c]) for c in fit.fill})


@dataclass
class CategoryFit:
    """Most frequent value and sorted categories per column."""

    fill: dict[str, str]
    categories: dict[str, list[str]]


def fit_categories(df: DataFrame, cols: Sequence[str], limit: int = MAX_CATEGORIES) -> CategoryFit:
    """Category lists become columns, so a column with more than `limit` values is refused."""
    fill, cats = {}, {}
    for c in cols:
        fill[c] = df.limit(1).select(mode_value(df, c).alias("m")).first()["m"]
        found = [r[0] for r in df.where(F.col(c).isNotNull()).select(c).distinct().limit(limit + 1).collect()]
        if len(found) > limit:
            raise ValueError(f"{c}: more than {limit} categories; use target encoding or codes")
        cats[c] = sorted(found)
    return CategoryFit(fill, cats)


def one_hot(df: DataFrame, fit: CategoryFit) -> DataFrame:
    """Columns `<column>_<value>`, first category dropped, unseen values all zero."""
    out = {}
    for c, values in fit.categories.items():
        filled = F.coalesce(F.col(c), F.lit(fit.fill[c]))
        out |= {f"{c}_{v}": F.when(filled == v, 1.0).otherwise(0.0) for v in values[1:]}
    return df.withColumns(out).drop(*fit.categories)


def fit_category_codes(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, value, code, filled, size): the categories of each text column as a table, whatever their number.

    Codes count from -1 along the values, so the first category, whose code is
    no place, is the one that is dropped; size is the number of places; filled
    marks the most frequent value (the smallest of equal ones), which stands in
    for NULL.  All columns are counted in one pass.
    """
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for c in cols])
    counts = settle(df.select(F.explode(cells).alias("r")).select("r.*").where("value is not null").groupBy("column", "value").agg(
        F.count(F.lit(1)).alias("n")), "categories")
    # a row for each column
    each = counts.groupBy("column").agg((F.count(F.lit(1)) - 1).alias("size"), F.min(F.struct(-F.col("n"), "value")).alias("most"))
    numbered = number_rows(counts, ["value"], ["column"], "code").join(each, "column")
    return settle(numbered.select("column", "value", (F.col("code") - 2).cast("int").alias("code"),
                                  (F.col("value") == F.col("most.value")).alias("filled"), F.col("size").cast("int").alias("size")), "category-codes")


def sparse_one_hot(df: DataFrame, cols: Sequence[str], codes: DataFrame, name: str = "features") -> DataFrame:
    """df with one sparse vector of all the columns' categories in `name`, columns in their given order; the columns stay.

    NULL takes the most frequent value's place; the first category and values
    that the fit has not seen have none.  A code table is joined per column, so
    no list of values becomes columns or literals, and the driver learns one
    size a column.
    """
    sizes = {r["column"]: r["size"] for r in codes.where("filled").select("column", "size").collect()}
    used = [c for c in cols if sizes.get(c, 0) > 0]
    out, places, first = df, [], 0
    for i, c in enumerate(used):
        own = codes.where(F.col("column") == c)
        most = own.where("filled").agg(F.max("value")).scalar()
        table = own.select(F.col("value").alias(f"_v{i}"), F.col("code").alias(f"_c{i}"))
        out = out.withColumn(f"_v{i}", F.coalesce(F.col(f"`{c}`").cast("string"), most)).join(table, f"_v{i}", "left")
        # a code beyond the last place has no place either
        places.append(F.when(F.col(f"_c{i}").between(0, sizes[c] - 1), F.col(f"_c{i}") + first))
        first += sizes[c]
    if not used:
        return out.withColumn(name, array_to_vector(F.array().cast("array<double>")))
    # the number of places is all that a later stage is told of them: names for each would grow with the categories
    vector = _indicator(first)(F.array_compact(F.array(*places))).alias(name, metadata={"ml_attr": {"num_attrs": first}})
    return out.select("*", vector).drop(*[f"_{k}{i}" for i in range(len(used)) for k in "vc"])


def _indicator(size: int):
    """Ascending places to a vector of ones there, dense only where that is shorter."""
    def vector(places: list[int]):
        found = SparseVector(size, places, [1.0] * len(places))
        return found if 1.5 * (len(places) + 1) < size else DenseVector(found.toArray())

    return F.udf(vector, VectorUDT())


def places_on(vector: Column) -> Column:
    """Array of (place, value) of a vector's entries other than zero; its length follows them, not the vector's size."""
    v = F.unwrap_udt(vector)
    sparse = F.arrays_zip(v["indices"].alias("place"), v["values"].alias("value"))
    dense = F.transform(v["values"], lambda x, i: F.struct(i.alias("place"), x.alias("value")))
    return F.filter(F.when(v["type"] == 0, sparse).otherwise(dense), lambda r: r["value"] != 0)


def fit_target_encoding(df: DataFrame, col: str, label: str) -> DataFrame:
    """(value, encoding): label mean shrunk to the overall mean by empirical Bayes.

    The weight of a category with n rows and label variance v is
    s2 n / (s2 n + v), s2 being the overall label variance (population).
    """
    y = F.col(label).cast("double")
    all_rows = df.agg(F.struct(F.avg(y).alias("m"), F.var_pop(y).alias("v")).alias("a")).scalar()
    g = df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("value")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(y).alias("m"), F.var_pop(y).alias("v")).withColumn("a", all_rows)
    spread = F.col("a.v") * F.col("n")
    w = ratio(spread, spread + F.col("v"), 1)
    return g.select("value", (w * F.col("m") + (1 - w) * F.col("a.m")).alias("encoding"), F.col("a.m").alias("overall"))


def target_encode(df: DataFrame, col: str, table: DataFrame) -> DataFrame:
    """Replace a column by its fitted encoding; unseen values get the overall mean."""
    overall = table.agg(F.max("overall")).scalar()
    t = table.select(F.struct(F.col("value").cast(df.schema[col].dataType).alias(col)).alias("_value"), "encoding")
    coded = df.withColumn("_value", F.struct(col)).join(t, "_value", "left")
    return coded.withColumn(col, F.coalesce(F.col("encoding"), overall)).drop("encoding", "_value")


def target_encode_cross_fitted(df: DataFrame, col: str, label: str, fold: str) -> DataFrame:
    """Encode every row from the other folds: statistics per (value, fold) subtracted from the totals."""
    y = F.col(label).cast("double")
    stats = df.groupBy(col, fold).agg(F.count(F.lit(1)).alias("n"), F.sum(y).alias("s"))
    folds = stats.groupBy(fold).agg(F.sum("n").alias("fn"), F.sum("s").alias("fs"))
    all_rows = stats.agg(F.struct(F.sum("n").alias("n"), F.sum("s").alias("s")).alias("a")).scalar()
    per_value = stats.groupBy(col).agg(F.sum("n").alias("vn"), F.sum("s").alias("vs"))
    # a struct of the value is never NULL, so NULL is a category like any other
    grid = stats.withColumn("_value", F.struct(col)).join(per_value.select(F.struct(col).alias("_value"), "vn", "vs"), "_value")
    grid = grid.join(folds, fold).withColumn("a", all_rows)
    n, s = F.col("vn") - F.col("n"), F.col("vs") - F.col("s")
    rest_n, rest_s = F.col("a.n") - F.col("fn"), F.col("a.s") - F.col("fs")
    mean, overall = ratio(s, n), rest_s / rest_n
    spread = overall * (1 - overall) * n
    w = ratio(spread, spread + mean * (1 - mean), 1)
    enc = F.when(n > 0, w * mean + (1 - w) * overall).otherwise(overall)
    known = grid.select("_value", fold, enc.alias("encoding"))
    return df.withColumn("_value", F.struct(col)).join(known, ["_value", fold], "left").drop("_value")


def interactions(df: DataFrame, cols: Sequence[str] | None = None, pairs: Sequence[tuple[str, str]] | None = None,
                 limit: int = 20) -> DataFrame:
    """Products `a_x_b` of the first `limit` column pairs, and `a_div_b` where b is never zero."""
    if pairs is None:
        pairs = list(combinations(cols or numeric_columns(df), 2))[:limit]
    if not pairs:
        return df
    divisors = sorted({b for _, b in pairs})
    # a missing divisor is not zero, so only zeros count
    zero = df.agg(*[F.count_if(F.col(b) == 0).alias(b) for b in divisors]).first()
    out: dict[str, Column] = {}
    for a, b in pairs:
        out[f"{a}_x_{b}"] = F.col(a) * F.col(b)
        if zero[b] == 0:
            out[f"{a}_div_{b}"] = F.try_divide(F.col(a).cast("double"), F.col(b).cast("double"))
    return df.withColumns(out)


def anova_scores(df: DataFrame, cols: Sequence[str], label: str) -> DataFrame:
    """(column, score): F of the label classes per feature, from per-class sums."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x")) for c in cols])
    per = df.select(F.col(label).alias("y"), F.explode(cells).alias("r")).select("y", "r.*").dropna().groupBy("column", "y").agg(
        F.count(F.lit(1)).alias("n"), F.avg("x").alias("m"), F.var_pop("x").alias("v"))
    t = per.groupBy("column").agg(
        F.sum("n").alias("total"), F.count(F.lit(1)).alias("k"), (F.sum(F.col("n") * F.col("m")) / F.sum("n")).alias("mean"),
        F.sum(F.col("n") * F.col("v")).alias("within"))
    between = per.join(t, "column").groupBy("column").agg(
        F.sum(F.col("n") * (F.col("m") - F.col("mean")) * (F.col("m") - F.col("mean"))).alias("between"))
    t = t.join(between, "column")
    score = ratio(F.col("between") / (F.col("k") - 1), F.col("within") / (F.col("total") - F.col("k")))
    return t.select("column", score.alias("score"))


def mutual_information_scores(df: DataFrame, cols: Sequence[str], label: str, bins: int = 10) -> DataFrame:
    """(column, score): mutual information between quantile-binned features and the label, in nats."""
    edges = fit_quantiles(df, cols, [i / bins for i in range(1, bins)])
    cells = []
    for c in cols:
        place = F.lit(0)
        for e in sorted({e for e in edges[c] if e is not None}):
            place = place + F.when(F.col(c) > F.lit(e), 1).otherwise(0)
        cells.append(F.struct(F.lit(c).alias("column"), F.when(F.col(c).isNotNull(), place).alias("x")))
    joint = df.select(F.col(label).alias("y"), F.explode(F.array(*cells)).alias("r")).select("y", "r.*").dropna().groupBy(
        "column", "x", "y").agg(F.count(F.lit(1)).alias("n"))
    px = joint.groupBy("column", "x").agg(F.sum("n").alias("nx"))
    py = joint.groupBy("column", "y").agg(F.sum("n").alias("ny"))
    pn = joint.groupBy("column").agg(F.sum("n").alias("total"))
    t = joint.join(px, ["column", "x"]).join(py, ["column", "y"]).join(pn, "column")
    n, N = F.col("n").cast("double"), F.col("total").cast("double")
    return t.groupBy("column").agg(F.sum(n / N * F.ln(n * N / (F.col("nx").cast("double") * F.col("ny")))).alias("score"))


def variance_scores(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, score): population variance per feature."""
    one = df.agg(*[F.var_pop(c).alias(f"v{i}") for i, c in enumerate(cols)])
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"v{i}").alias("score")) for i, c in enumerate(cols)])
    return one.select(F.explode(cells).alias("r")).select("r.*")


def importance_table(scores: DataFrame, top: int | None = None, above: float | None = None) -> DataFrame:
    """Scores sorted descending with a `selected` flag (best `top`, or score above a limit)."""
    from pyspark.sql import Window as W

    rank = F.row_number().over(W.orderBy(F.col("score").desc_nulls_last(), "column"))  # one row per feature
    keep = rank <= top if top is not None else F.coalesce(F.col("score") > F.lit(above), F.lit(False))
    return scores.withColumn("selected", keep).orderBy(F.col("score").desc_nulls_last(), "column")


def selected_columns(importance: DataFrame) -> list[str]:
    return [r["column"] for r in importance.where("selected").select("column").collect()]


def fit_pca(df: DataFrame, cols: Sequence[str], k: int):
    """Centred PCA: (means, Spark ML model)."""
    one = df.agg(*[F.avg(c).alias(c) for c in cols]).first()
    means = {c: one[c] for c in cols}
    return means, PCA(k=k, inputCol="_vec", outputCol="_pca").fit(_centred(df, means))


def _centred(df: DataFrame, means: dict[str, float]) -> DataFrame:
    shifted = df.withColumns({f"_c_{c}": F.col(c).cast("double") - F.lit(m) for c, m in means.items()})
    return VectorAssembler(inputCols=[f"_c_{c}" for c in means], outputCol="_vec").transform(shifted).drop(*[f"_c_{c}" for c in means])


def apply_pca(df: DataFrame, fit) -> DataFrame:
    means, model = fit
    out = model.transform(_centred(df, means)).withColumn("_pca", vector_to_array("_pca"))
    return out.withColumns({f"pc{i + 1}": F.get("_pca", i) for i in range(model.getK())}).drop("_vec", "_pca")


def infer_transaction_columns(df: DataFrame) -> Transactions | None:
    """First customer-like, date and value-like columns by name and type; None when one is missing.

    Without a value-like name the first other numeric column is the value.
    """
    dates = [c for c, t in df.dtypes if t in ("date", "timestamp", "timestamp_ntz")]
    ids = [c for c in df.columns if "id" in c.lower() or "customer" in c.lower()]
    values = [c for c in numeric_columns(df) if any(w in c.lower() for w in ("amount", "value", "price"))]
    values += [c for c in numeric_columns(df) if ids and c != ids[0]]
    return Transactions(ids[0], dates[0], values[0]) if dates and ids and values else None


@dataclass
class FeaturePipeline:
    """Temporal features, numeric and one-hot preprocessing, optional interactions and selection, fitted once.

    With `with_temporal` every row gets its customer's figures (columns
    `rfm_...`), which are numbers like the others from there on; the customer
    and date columns themselves pass through, as do all outside `numeric` and
    `texts`.  `save` writes the
    fitted parameters as a one-row table.
    """

    impute: str = "median"
    scale: str = "standard"
    with_interactions: bool = False
    selection: str | None = None
    max_features: int = 100
    with_temporal: bool = False
    keep: list[str] = field(default_factory=list)
    numeric: dict | None = None
    texts: dict | None = None
    pairs: list | None = None
    selected: list | None = None
    temporal: dict | None = None
    reference: str | None = None

    def fit(self, df: DataFrame, label: str | None = None) -> "FeaturePipeline":
        if self.with_temporal:
            tx = infer_transaction_columns(df)
            if tx:
                self.temporal, self.reference = asdict(tx), str(fit_reference_date(df, tx))
        df = self._timed(df)
        skip = {*self.keep, *([label] if label else []), *([self.temporal["customer"], self.temporal["date"]] if self.temporal else [])}
        nums = [c for c in numeric_columns(df) if c not in skip]
        texts = [c for c in text_columns(df) if c not in skip]
        self.numeric = asdict(fit_numeric(df, nums, self.impute, self.scale))
        self.texts = asdict(fit_categories(df, texts))
        out = self._prepared(df)
        if self.with_interactions:
            made = set(interactions(out, nums).columns) - set(out.columns)
            self.pairs = [[name, a, b, op] for a, b in combinations(nums, 2) for op in ("x", "div") if (name := f"{a}_{op}_{b}") in made]
            out = self._interact(out)
        if self.selection and label:
            cols = self.output_columns(nums)
            scores = {"f_classif": anova_scores, "mutual_info": mutual_information_scores}
            if self.selection == "variance":
                table = importance_table(variance_scores(out, cols), above=0.01)
            else:
                table = importance_table(scores[self.selection](out, cols, label), top=self.max_features)
            self.selected = selected_columns(table)
        return self

    def output_columns(self, nums: Sequence[str] | None = None) -> list[str]:
        if self.selected is not None:
            return self.selected
        names = list(nums if nums is not None else self.numeric["fill"])
        names += [f"{c}_{v}" for c, values in self.texts["categories"].items() for v in values[1:]]
        return names + [p[0] for p in self.pairs or []]

    def _prepared(self, df: DataFrame) -> DataFrame:
        return one_hot(apply_numeric(df, NumericFit(**self.numeric)), CategoryFit(**self.texts))

    def _interact(self, df: DataFrame) -> DataFrame:
        out = {}
        for name, a, b, op in self.pairs or []:
            x, y = F.col(f"`{a}`"), F.col(f"`{b}`")
            out[name] = x * y if op == "x" else F.try_divide(x, y)
        return df.withColumns(out) if out else df

    def _timed(self, df: DataFrame) -> DataFrame:
        """df with its customers' temporal figures, before anything is filled or scaled."""
        if not self.temporal:
            return df
        tx = Transactions(**self.temporal)
        rfm = rfm_features(df, tx, F.lit(self.reference).cast("timestamp_ntz"))
        figures = [F.col(c).alias(f"rfm_{c}") for c in rfm.columns if c not in (tx.customer, "last_date", "first_date")]
        return df.join(rfm.select(tx.customer, *figures), tx.customer, "left")

    def transform(self, df: DataFrame) -> DataFrame:
        out = self._interact(self._prepared(self._timed(df)))
        if self.selected is not None:
            dropped = set(FeaturePipeline.output_columns(_unselected(self))) - set(self.selected)
            out = out.drop(*dropped)
        return out

    def save(self, spark: SparkSession, path: str) -> None:
        spark.createDataFrame([(json.dumps(asdict(self)),)], "fitted string").write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> "FeaturePipeline":
        return FeaturePipeline(**json.loads(spark.read.parquet(path).first()["fitted"]))


def _unselected(p: FeaturePipeline) -> FeaturePipeline:
    return FeaturePipeline(**{**asdict(p), "selected": None})
