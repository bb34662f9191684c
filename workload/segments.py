"""Clustering, cluster quality and segment profiles."""

from pyspark.sql import functions as F

from retenta.operators import segments as G
from workload.base import SCORED_SQL, scored
from workload.registry import query

WITH = "WITH " + SCORED_SQL
COLS = ["frequency", "monetary", "balance"]


@query("kmeans_segments")
def kmeans_segments(t):
    return G.kmeans_segments(scored(t), "customer_id", COLS, 4)


@query("choose_k")
def choose_k(t):
    return G.choose_k(scored(t), "customer_id", COLS)


@query("choose_k_hierarchical")
def choose_k_hierarchical(t):
    return G.choose_k(scored(t), "customer_id", COLS, method="hierarchical")


@query("ward_dendrogram")
def ward_dendrogram(t):
    vec = G.standardised(scored(t), "customer_id", COLS)
    return G.Dendrogram.fit(vec).table(t.spark)


@query("hierarchical_segments")
def hierarchical_segments(t):
    return G.hierarchical_segments(scored(t), "customer_id", COLS, 4)


def _quality_sql(rel: str, seg: str, cols: list[str]) -> str:
    sq = " + ".join(f"power({c} - m_{c}, 2)" for c in cols)
    bt = " + ".join(f"power(m_{c} - g_{c}, 2)" for c in cols)
    ab = " + ".join(f"power(a.m_{c} - b.m_{c}, 2)" for c in cols)
    return f"""cent AS (SELECT {seg} AS s, count(*) AS n, {', '.join(f'avg({c}) AS m_{c}' for c in cols)} FROM {rel} GROUP BY 1),
w AS (SELECT s, any_value(n) AS n, {', '.join(f'any_value(m_{c}) AS m_{c}' for c in cols)}, sum({sq}) AS wss, avg(sqrt({sq})) AS sd FROM {rel} JOIN cent ON s = {seg} GROUP BY s),
g AS (SELECT {', '.join(f'avg({c}) AS g_{c}' for c in cols)}, count(*) AS nn FROM {rel}),
db AS (SELECT avg(r) AS davies_bouldin FROM (SELECT a.s, max((a.sd + b.sd) / sqrt({ab})) AS r FROM w a JOIN w b ON a.s <> b.s GROUP BY a.s))
SELECT count(*) AS n_clusters, (sum(n * ({bt})) * (any_value(nn) - count(*))) / (sum(wss) * (count(*) - 1)) AS calinski_harabasz, any_value(davies_bouldin) AS davies_bouldin FROM w, g, db"""


@query("cluster_quality", WITH + ", " + _quality_sql("scored", "segment", ["frequency", "balance"]), real="calinski_harabasz davies_bouldin", whole="n_clusters", digits=5)
def cluster_quality(t):
    return G.cluster_quality(scored(t), ["frequency", "balance"], "segment")


DIMS = [f"e{i}" for i in range(64)]


@query("embedding_cluster_quality", "WITH emb AS (SELECT label, " + ", ".join(f"embedding[{i + 1}]::DOUBLE AS e{i}" for i in range(64)) + " FROM embeddings), "
       + _quality_sql("emb", "label", DIMS), real="calinski_harabasz davies_bouldin", whole="n_clusters", digits=4)
def embedding_cluster_quality(t):
    e = t.embeddings.select("label", *[F.get("embedding", i).cast("double").alias(f"e{i}") for i in range(64)])
    return G.cluster_quality(e, DIMS, "label")


@query("segment_sizes", WITH + "SELECT segment, count(*) AS size, avg(label) AS churn_rate, count(*) * 100e0 / (SELECT count(*) FROM scored) AS size_pct FROM scored GROUP BY segment",
       real="churn_rate size_pct", whole="size")
def segment_sizes(t):
    return G.segment_sizes(scored(t), "segment", "label")


@query("segment_numeric_profile", WITH + """,
l AS (SELECT segment, 'frequency' AS "column", frequency::DOUBLE AS x FROM scored UNION ALL SELECT segment, 'monetary', monetary FROM scored UNION ALL SELECT segment, 'balance', balance FROM scored),
p AS (SELECT segment, "column", avg(x) AS mean, quantile_cont(x, 0.5) AS median, stddev_samp(x) AS std FROM l GROUP BY ALL),
o AS (SELECT "column", avg(x) AS om FROM l GROUP BY 1)
SELECT segment, "column", mean, median, std, abs(mean - om) / abs(om) AS relative_difference, row_number() OVER (PARTITION BY segment ORDER BY abs(mean - om) / abs(om) DESC) <= 2 AS is_top_feature FROM p JOIN o USING ("column")""",
       real="mean median std relative_difference", digits=5)
def segment_numeric_profile(t):
    return G.segment_numeric_profile(scored(t), "segment", COLS, top=2)


@query("segment_categorical_profile", WITH + """,
c AS (SELECT label, 'segment' AS "column", segment AS v, count(*) AS n FROM scored GROUP BY ALL UNION ALL SELECT label, 'nation_key', CAST(nation_key AS VARCHAR), count(*) FROM scored GROUP BY ALL)
SELECT label, "column", v AS mode, n / (SELECT count(*) FROM scored s WHERE s.label = c.label) AS mode_frequency FROM c QUALIFY row_number() OVER (PARTITION BY label, "column" ORDER BY n DESC, v) = 1""", real="mode_frequency")
def segment_categorical_profile(t):
    return G.segment_categorical_profile(scored(t), "label", ["segment", "nation_key"])
