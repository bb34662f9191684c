"""Operators on documents: definitions, round trips, held-out accuracy, odd rows."""

import zlib

import duckdb
import numpy as np
import public_tokenizers
from pyspark.sql import functions as F

import corpus_pipeline
from retenta.llm import html, langid, linededup, mixing, packing, quality, toxicity
from retenta.llm.queries import QUERIES, SQL

DATA = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [(1, None, "x", "b", 0), (2, "", None, None, None), (3, "a  b\tc d e", "x", "a", 1), (3, "a  b\tc d e", "x", "a", 1), (None, "q w e", "x", "c", 1),
       (5, "12 34 ,,,", "x", "b", 1), (6, "long " * 30000, "y", "a", 1), (7, "last\n" * 50, "y", "a", 1)]


def odd(spark):
    return spark.createDataFrame(ODD, DOCS).withColumn("score", F.lit("clash")).withColumn("size", F.lit("clash"))


def test_queries_are_named_for_their_operators():
    assert [int(n[2:].split("_")[0]) for n in QUERIES] == list(range(1, 14)) and set(SQL) <= set(QUERIES)


def test_targets_fill_up_to_the_limit():
    got = mixing.targets(np.array([1000, 100, 400]), np.array([5.0, 2.0, 1.0]))
    assert np.allclose(got, [2050 * 5 / 6, 200, 2050 / 6])
    assert mixing.targets(np.array([0, 0]), np.array([5.0, 2.0])).tolist() == [0, 0]


def test_permutation_and_shards():
    for n in (1, 2, 3, 7, 64, 1000):
        assert sorted(mixing.permute(np.arange(n), n, (1, 2, 3))) == list(range(n))
    slots = np.array([1000, 0, 37])
    parts = [mixing.shard_slots(slots, 7, i) for i in range(7)]
    assert sum(c for _, c in parts).tolist() == slots.tolist()
    assert all((parts[i][0] + parts[i][1]).tolist() == parts[i + 1][0].tolist() for i in range(6))


def test_mix(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    rows = mixing.mix_counts(docs).collect()
    again = {r["doc_id"]: r["taken"] for r in mixing.mix_counts(docs).collect()}
    sizes = {r["doc_id"]: len((r["text"] or "").encode().split()) for r in docs.collect()}
    assert {r["doc_id"]: r["size"] for r in rows} == sizes and all(r["taken"] <= 2 * r["size"] for r in rows)
    assert {r["doc_id"]: r["taken"] for r in rows} == again
    per = {}
    for r in rows:
        per.setdefault((r["target"], r["source_size"]), []).append(r["taken"])
    assert all(abs(sum(v) / t - 1) < 0.02 for (t, _), v in per.items())
    mixed = mixing.mix_documents(docs).collect()
    words = {}
    for r in mixed:
        words[r["doc_id"]] = words.get(r["doc_id"], 0) + len(r["text"].split())
    assert words == {k: v for k, v in again.items() if v}


def test_mix_odd_rows(spark):
    got = mixing.mix_counts(odd(spark)).collect()
    assert sorted((r["doc_id"] or 0, r["size"]) for r in got) == [(0, 3), (1, 0), (2, 0), (3, 5), (3, 5), (5, 3), (6, 30000), (7, 50)]
    assert all(r["taken"] <= 2 * r["size"] for r in got)
    assert mixing.mix_counts(odd(spark).limit(0)).count() == 0 and mixing.mix_documents(odd(spark).limit(0)).count() == 0
    assert {r["doc_id"] for r in mixing.mix_documents(odd(spark)).collect()} <= {None, 3, 5, 6, 7}


def test_packing_round_trip(spark):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    own = Tokenizer.from_file(path)
    docs = odd(spark).where("doc_id is not null").dropDuplicates(["doc_id"]).union(
        spark.createDataFrame([(100 + i, "Éé 漢字 \U0001f600 x%d " % i * (i * 7), "x", "s", 1) for i in range(60)], DOCS)
        .withColumn("score", F.lit("")).withColumn("size", F.lit("")))
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    pieces = sorted(packing.pack(docs, path, public_tokenizers.PATTERN, group=16).collect(), key=lambda r: (r["doc_id"], r["start"]))
    at = dict.fromkeys(texts, 0)
    coded = {k: np.array([*own.encode(t, add_special_tokens=False).ids, 1], dtype="<u4") for k, t in texts.items()}
    for p in pieces:
        ids = coded[p["doc_id"]]
        assert p["start"] == at[p["doc_id"]] and p["doc_tokens"] == len(ids)
        at[p["doc_id"]] += p["length"]
        assert p["ids_crc32"] == zlib.crc32(ids[p["start"]:at[p["doc_id"]]].tobytes())
    assert at == {k: len(v) for k, v in coded.items()}
    seqs = {}
    for p in sorted(pieces, key=lambda p: p["offset"]):
        assert seqs.setdefault(p["sequence_id"], 0) == p["offset"]
        seqs[p["sequence_id"]] += p["length"]
    assert all(n <= 2048 and n & (n - 1) == 0 for n in seqs.values())
    assert packing.pack(odd(spark), path, public_tokenizers.PATTERN).select("doc_id").distinct().count() == 7
    assert packing.pack(odd(spark).limit(0), path, public_tokenizers.PATTERN).count() == 0


def test_packing_encodes_as_tokenizers_does():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    own, mine = Tokenizer.from_file(path), packing.encoder(path, public_tokenizers.PATTERN)
    for text in ("one <|endoftext|> two", "<|endoftext|>" * 3, "a<|endoftext|", "a" + "\n" * 1_100_000 + "b", " " * 1_100_000, " \n" * 600_000 + "x", "after"):
        assert mine.encode(text) == own.encode(text, add_special_tokens=False).ids
    assert mine.encode("one <|endoftext|> two")[2] == 50256 and mine.n_vocab == 50257


def test_language(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    truth = {r["doc_id"]: r["lang"] for r in docs.collect()}
    held = [r for r in langid.identify(docs).collect() if r["held_out"]]
    assert {zlib.crc32(str(r["doc_id"]).encode()) % 4 for r in held} == {2}
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in held]) > 0.97 and all(0 <= r["score"] <= 1 for r in held)
    got = {r["doc_id"]: r["lang_pred"] for r in langid.annotate(odd(spark), langid.fit(docs)).collect()}
    assert got[1] == got[2] == got[5] == "und" and len(got) == 7 and got[6] != "und"
    assert langid.identify(odd(spark).limit(0)).count() == 0 and langid.identify(odd(spark)).count() == len(ODD)
    assert sorted(r["doc_id"] or 0 for r in langid.reject_unknown(docs.limit(50)).collect()) == sorted(r["doc_id"] for r in docs.limit(50).collect())


def test_many_languages_reject_no_known_text(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("lang = 'en'")
    spelt = docs.withColumn("lang", F.concat("lang", F.pmod(F.xxhash64("doc_id"), F.lit(8)).cast("string")))
    assert spelt.select("lang").distinct().count() == 8
    assert langid.reject_unknown(spelt).count() == docs.count()
    base = next(langid.grams("the quick brown fox jumps over the lazy dog"))
    similar = langid.LanguageFilters.build([f"l{i:02d}" for i in range(24)], [np.concatenate([base[::3], base[1::3], base[2::3][:i % 4]]) for i in range(24)])
    assert similar.predict("the quick brown fox jumps over the lazy dog")[1] < 0.1 and similar.recognised("the quick brown fox jumps over the lazy dog") > 0.6
    assert similar.recognised("Zwölf 漢字 ÿÿ") < 0.3 and similar.recognised(None) == similar.recognised("12 34") == 0


def test_more_than_64_languages_share_one_table():
    rng = np.random.default_rng(0)
    contents = [rng.integers(0, 1 << 62, 300).astype(np.uint64) for _ in range(70)]
    f = langid.LanguageFilters.build([f"l{i:02d}" for i in range(70)], contents)
    masks = f.table[langid._slots(contents[69], len(f.table), f.hashes)]
    both = masks[0] & masks[1] & masks[2]
    assert f.table.shape[1] == 2 and ((both[:, 1] >> np.uint64(5)) & np.uint64(1)).all()


def test_quality_and_toxicity_learn(spark):
    rng = np.random.default_rng(5)
    plain = [f"w{i}" for i in range(300)]
    docs, labels = [], []
    for i in range(400):
        words = [plain[j] for j in rng.integers(0, 300, rng.integers(20, 80))]
        toxic, bad = i % 5 == 0, i % 3 == 0
        for k in range(2 if toxic else 0):
            words.insert(int(rng.integers(len(words))), ["vile", "rotten"][k])
        docs.append((i, " ".join(w + "%%%" if bad else w for w in words), "en", "s", 1))
        labels.append((i, int(not bad), int(toxic)))
    d = spark.createDataFrame(docs + ODD[:2], DOCS)
    lab = spark.createDataFrame(labels + [(None, 1, 1), (3, None, None), (4, 0, 0)], "doc_id long, quality int, toxic int")
    truth = {i: (q, t) for i, q, t in labels}
    model = quality.fit(d, lab)
    got = quality.score(d, model).collect()
    assert len(got) == 402 and np.mean([r["predicted"] == truth[r["doc_id"]][0] for r in got if r["held_out"]]) > 0.95
    f = langid.fit(d)
    net = toxicity.fit(d, lab, f)
    got = toxicity.score(d, net, f).collect()
    assert len(got) == 402 and np.mean([r["predicted"] == truth[r["doc_id"]][1] for r in got if r["held_out"]]) > 0.9
    none = lab.limit(0)
    assert {r["score"] for r in quality.score(odd(spark), quality.fit(d, none)).collect()} == {0.5}
    assert toxicity.score(odd(spark), toxicity.fit(d, none, f), f).count() == len(ODD)
    assert toxicity.score(d.limit(0), net, f).count() == quality.score(d.limit(0), model).count() == 0


def test_line_templates(spark):
    common = "All rights are reserved by the owner"
    rows = [(1, f"one unique line here\n{common}\nOrder 17 was shipped on day 4 to the customer", "x", "s", 1),
            (2, f"{common}\nanother text that stands alone\nOrder 9 was shipped on day 22 to the customer", "x", "s", 1),
            (3, "The quick brown fox jumps over the lazy dog today\nno\nno", "x", "s", 1),
            (4, "The quick brown fox jumps over the lazy cat today\nno", "x", "s", 1), (5, None, "x", "s", 1), (6, "", "x", "s", 1),
            (None, common, "x", "s", 1), (7, "same here twice\nsame here twice", "x", "s", 1), (7, "same here twice\nsame here twice", "x", "s", 1)]
    docs = spark.createDataFrame(rows, DOCS).withColumn("leaf", F.lit("clash")).withColumn("n_lines", F.lit("clash"))
    got = {r["doc_id"]: r for r in linededup.drop_lines(docs).collect()}
    assert got[1]["text"] == rows[0][1] and got[2]["text"] == "another text that stands alone" and got[2]["n_dropped"] == 2
    assert got[4]["text"] == "no" and got[3]["text"] == rows[2][1] and got[5]["text"] is None and got[6]["text"] == ""
    assert got[None]["text"] == common and got[7]["n_dropped"] == 0 and linededup.drop_lines(docs).count() == len(rows)
    assert linededup.drop_lines(docs.limit(0)).count() == 0


def test_short_lines_recur_as_they_are(spark):
    rows = [(1, "Les.\n漢字仮名交じり文はここに\nPage 3\n\none line stays here\nLes.", "x", "s", 1), (2, " Les.\n漢字仮名交じり文はここに\nPage 4\n\nof its own kind", "x", "s", 1),
            (3, "Page 4\n12\n", "x", "s", 1), (4, "13\n \nLes.", "x", "s", 1), (None, "Les.", "x", "s", 1), (5, None, "x", "s", 1)]
    docs = spark.createDataFrame(rows, DOCS)
    got = {r["doc_id"]: (r["text"], r["n_dropped"]) for r in linededup.drop_lines(docs, short=True).collect()}
    assert got == {1: (rows[0][1], 0), 2: ("Page 4\n\nof its own kind", 2), 3: ("12\n", 1), 4: ("13\n ", 1), None: ("Les.", 0), 5: (None, 0)}
    stage = dict(corpus_pipeline.STAGES)["line_dedup"]
    assert {r["doc_id"]: r["text"] for r in stage(spark, docs, "").collect()} == {k: v[0] for k, v in got.items()}


def test_line_dedup_equals_sql(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    con = duckdb.connect()
    con.execute("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.001/documents.parquet'")
    mine = sorted(map(tuple, linededup.drop_lines(docs.select("doc_id", "text")).select("doc_id", "text", "n_lines", "n_dropped").collect()))
    assert mine == sorted(con.execute(linededup.SQL).fetchall())


def test_html_layout(spark):
    page = """<html><head><title>x</title><style>p{}</style></head><body><h1>Head &amp; more</h1><p>One <b>two</b>
 three<p>Four<br>five<ul><li>a<li>b<ol><li>x</li><li>y</ol><li>c</ul><table><tr><th>Name<th>N</tr><tr><td>alpha<td>1<tr><td>be<td>22</table>
<div style="display:none">no</div><div hidden>no</div><!-- no --><script>"</p>"</script><pre>  keep
   this</pre>end</body>"""
    want = "Head & more\n\nOne two three\n\nFour\nfive\n\n- a\n- b\n  1. x\n  2. y\n- c\n\nName   N\nalpha  1\nbe     22\n\n  keep\n   this\n\nend"
    assert html.extract_text(page) == want
    rows = [(1, page), (2, None), (3, ""), (None, "<p>x"), (4, "<div>" * 5000 + "deep"), (4, "a < b & c <unclosed"), (5, "<a b='" * 3000)]
    df = spark.createDataFrame(rows, "page_id long, html string").withColumn("text", F.lit("clash"))
    got = [tuple(r) for r in html.extract(df).collect()]
    assert len(got) == 7 and got[0] == (1, want) and got[1] == (2, None) and got[2] == (3, "") and got[3] == (None, "x") and got[4] == (4, "deep")
    assert got[5][1].startswith("a < b & c") and html.extract(df.limit(0)).count() == 0


def test_html_text_outside_the_usual_tags():
    for part in ("<form>seen</form>", "<center>seen</center>", "<pre>seen</pre>", "<dl><dt>seen</dl>", "<blockquote>seen</blockquote>", "<a href=x>seen</a>", "seen"):
        for head in ("<head><title>t</title>", "<html><head><meta charset=x>\n<style>s</style>", "<body><head>"):
            assert html.extract_text(head + part).strip() == "seen"
    assert html.extract_text("<head><template><div>no</div>no</template><title>t</title></head>yes") == "yes"
    assert html.extract_text("<p>so <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>x</annotation></math> holds") == "so x=2 holds"
    drawing = "<svg><title>t</title><defs/><script href=x /><desc>d</desc><g><text>Q1</text><text>Q2</text></g><path d='x'/></svg>"
    assert html.extract_text(f"<div>a</div>{drawing}<p>b") == "a\nQ1\nQ2\n\nb"
    assert html.extract_text("<svg><defs><p>out") == "out" and html.extract_text("<svg><defs><text>no</defs><text>in") == "in"


def test_html_text_round_trip():
    rng = np.random.default_rng(1)
    for _ in range(50):
        blocks = [" ".join(f"w{j}&amp;" if j % 7 == 0 else f"w{j}" for j in rng.integers(0, 99, rng.integers(1, 9))) for _ in range(rng.integers(1, 6))]
        page = "<body>" + "".join(f"<p>{b}" + ("</p>" if rng.random() < 0.5 else "") for b in blocks)
        assert html.extract_text(page) == "\n\n".join(blocks).replace("&amp;", "&")


def test_pipeline_stages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").unionByName(
        spark.createDataFrame([(-1, "12 ,, 34", "en", "s", 8), (-2, None, "en", "s", 0)], DOCS))
    (_, language), (_, lines), (_, near), (_, mix), (_, pack) = corpus_pipeline.STAGES
    a = language(spark, docs, "")
    assert a.columns == list(corpus_pipeline.COLUMNS) and a.count() == docs.count() - 2
    b = lines(spark, a, "")
    assert b.count() == a.count() and b.columns == a.columns
    c = near(spark, b, "")
    assert c.columns == a.columns and c.count() == near(spark, c, "").count() <= b.count()
    d = mix(spark, c, "")
    assert d.columns == a.columns and d.count() > 0
    words = d.select(F.sum(F.size(F.split(F.trim("text"), r"\s+")))).first()[0]
    assert abs(words / (1.5 * c.where("n_chars > 0").select(F.sum(F.size(F.split(F.trim("text"), r"\s+")))).first()[0]) - 1) < 0.05
    assert pack(spark, d, "").agg(F.sum("length")).first()[0] > words


def test_taken_words_of_a_very_long_text(spark):
    n = 1_000_000
    runs = [(k, min(k + 64, n)) for k in range(0, n, 128)]
    df = spark.range(1).select(F.array_join(F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.concat(F.lit("w"), i.cast("string"))), " \t").alias("text"),
                               F.lit(n // 2).alias("words"), F.lit(n).alias("size"))
    blocks = F.transform(F.sequence(F.lit(0), F.lit(n - 1), F.lit(128)), lambda k: F.struct(k.cast("long").alias("from"), F.least(k + 64, F.lit(n)).cast("long").alias("to")))
    got = df.withColumn("runs", blocks).select(mixing._taken_text(F.col("text")).alias("t")).first()["t"]
    assert got == " ".join(f"w{i}" for a, b in runs for i in range(a, b))
