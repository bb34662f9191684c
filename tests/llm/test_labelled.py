"""Models of labelled documents learn from every labelled row, in shards."""

import zlib

import numpy as np
from pyspark.sql import functions as F

from retenta.llm import langid, quality, samples, toxicity

DOCS = "doc_id long, text string, lang string"


def _learnable(i):
    return zlib.crc32(str(i).encode()) % 5 != 0


def test_every_labelled_row_is_dealt(spark):
    n = 9000  # more than the 3,000 of each label that were drawn once
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id")).alias("text"))
    docs = docs.unionByName(spark.createDataFrame([(1, None), (None, "no id"), (2, "text 2")], "doc_id long, text string"))
    labels = spark.range(n).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("toxic"))
    labels = labels.unionByName(spark.createDataFrame([(2, 1), (None, 1), (n + 1, None)], "doc_id long, toxic int"))
    rows, shards, prior = samples.labelled(docs, labels, "toxic")
    got = rows.select("doc_id", "label", "shard").collect()
    want = sorted([i for i in range(n) if _learnable(i)] + [2] * _learnable(2))
    assert sorted(r["doc_id"] for r in got) == want
    assert all(r["label"] == (1 if r["doc_id"] == 2 else r["doc_id"] % 2) for r in got)
    assert shards == 2 and {r["shard"] for r in got} == {0, 1}
    ones = [i for i in range(n) if _learnable(i) and (i % 2 or i == 2)]
    assert prior == len(ones) / sum(map(_learnable, range(n)))


def test_shards_learn_together(spark, monkeypatch):
    monkeypatch.setattr(samples, "ROWS", 120)
    rng = np.random.default_rng(3)
    plain = [f"w{i}" for i in range(200)]
    docs, labels = [], []
    for i in range(600):
        words = [plain[j] for j in rng.integers(0, 200, rng.integers(20, 60))]
        toxic, bad = i % 4 == 0, i % 3 == 0
        if toxic:
            words.insert(int(rng.integers(len(words))), "vile")
        docs.append((i, " ".join(w + "%%%" if bad else w for w in words), "en"))
        labels.append((i, int(not bad), int(toxic)))
    d, lab = spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    truth = {i: (q, t) for i, q, t in labels}
    filters = langid.fit(d)
    net = toxicity.fit(d, lab, filters)
    for k, got in enumerate((quality.score(d, quality.fit(d, lab)).collect(), toxicity.score(d, net, filters).collect())):
        assert np.mean([r["predicted"] == truth[r["doc_id"]][k] for r in got if r["held_out"]]) > 0.9
    again = toxicity.fit(d.repartition(7), lab.repartition(3), filters)
    assert np.array_equal(net.table, again.table) and net.thresholds == again.thresholds


def test_thresholds_make_the_fewest_errors(spark):
    rng = np.random.default_rng(8)
    rows = [(("en", "de", "fr")[i % 3] if i < 600 else "xx", float(np.round(rng.normal(y := int(rng.random() < 0.4), 0.8), 1)), y) for i in range(605)]
    prior = 0.2
    got = toxicity.thresholds(spark.createDataFrame(rows, "lang string, logit double, label int"), prior)
    assert set(got) == {"", "en", "de", "fr"}
    for lang, cut in got.items():
        s, y = np.array([(v, k) for l, v, k in rows if lang in ("", l)]).T
        errors = lambda c: prior * ((s <= c) & (y == 1)).sum() / y.sum() + (1 - prior) * ((s > c) & (y == 0)).sum() / (1 - y).sum()
        values = np.unique(s)
        assert errors(cut) <= min(errors(c) for c in [values[0] - 1, *values]) + 1e-9
        assert cut not in values
    assert toxicity.thresholds(spark.createDataFrame([("en", 1.5, 1)], "lang string, logit double, label int"), 1.0) == {"": 0.5}
    assert toxicity.thresholds(spark.createDataFrame([], "lang string, logit double, label int"), 0.0).get("", 0.0) == 0.0


def test_texts_are_shuffled_once_and_only_if_labelled(spark, monkeypatch):
    monkeypatch.setattr(samples, "ROWS", 500)
    n = 12_000  # labelled ids on several pages of the bitmap
    docs = spark.range(2 * n).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id")).alias("text"))
    labels = spark.range(n).select((2 * F.col("id")).cast("int").alias("doc_id"), F.lit(1).alias("toxic"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)  # labels too large for a broadcast
    try:
        dealt = samples.deal(docs, labels, "toxic")
        want = [i for i in range(0, 2 * n, 2) if _learnable(i)]
        plan = dealt.rows._jdf.queryExecution().executedPlan().toString()
        got = dealt.rows.collect()
        bitmap, passing = samples._bitmap(labels, n, 42)
        passed = {r["doc_id"] for r in passing(docs).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" not in plan and "shufflepartitionidpassthrough" in plan
    assert sum("Exchange" in line and "Broadcast" not in line for line in plan.splitlines()) == 2  # the texts, and the labels' rows alone
    assert sorted(r["doc_id"] for r in got) == want and {r["text"] for r in got} == {f"text {i}" for i in want}
    assert dealt.shards > 1 and bitmap.count() > 1
    assert passed >= set(range(0, 2 * n, 2)) and len(passed) < 1.2 * n
    dealt.release()
