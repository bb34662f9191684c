"""Merkle manifest, periodic runs and license scan against plain Python."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from retenta.llm import license, merkle, periodic

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [(1, None, "x", "b", 0), (2, "", None, None, None), (3, "A  b\tc D e", "x", "a", 1), (3, "A  b\tc D e", "x", "a", 1), (3, "other", "x", "a", 1),
       (None, "Q w e", "x", "c", 1), (None, None, None, None, None), (5, "12 34 ,,,", "x", "b", 1), (6, "Long " * 30000, "y", "a", 1), (7, "last\n" * 50, "ÿ", "é", 1)]


def odd(spark, rows=ODD):
    clash = ("score", "digest", "tree", "lo", "hi", "proof", "n", "start", "label", "_range")
    return spark.createDataFrame(rows, DOCS).withColumns({c: F.lit("clash") for c in clash})


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def fold_tree(digests, fan):
    """(root, siblings of each leaf as (left, right) per level)."""
    proofs = [[] for _ in digests]
    members = [[i] for i in range(len(digests))]
    while len(digests) > 1:
        above, under = [], []
        for a in range(0, len(digests), fan):
            run = digests[a:a + fan]
            for k in range(len(run)):
                for leaf in members[a + k]:
                    proofs[leaf].append(("".join(run[:k]), "".join(run[k + 1:])))
            above.append(sha("".join(run)))
            under.append([x for m in members[a:a + fan] for x in m])
        digests, members = above, under
    return digests[0], proofs


def plain_audit(rows, fan=16):
    def leaf(r, text):
        values = (r[0], r[3], r[2], r[4], text)
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))

    def lower(t):
        return None if t is None else re.sub("[A-Z]", lambda m: m.group().lower(), t)

    per = {}
    for r in rows:
        per.setdefault(r[3], []).append((r, leaf(r, r[1])))
    order = sorted(per, key=lambda s: (s is not None, (s or "").encode()))
    built = {}
    for s in order:
        per[s].sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
        built[s] = fold_tree([d for _, d in per[s]], fan)
    if not order:
        return []
    root, tops = fold_tree([built[s][0] for s in order], fan)
    out = []
    for k, s in enumerate(order):
        for i, (r, own) in enumerate(per[s]):
            proof = built[s][1][i] + tops[k]
            changed = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            d = leaf(r, lower(r[1])) if changed else own
            for left, right in proof:
                d = sha(left + d + right)
            out.append((r[0], own, built[s][0], root, sha("".join(a + b for a, b in proof)), d, d == root))
    return out


@pytest.mark.parametrize("fan", [2, 16])
def test_merkle_equals_plain_python(spark, fan):
    rnd = random.Random(3)
    rows = list(ODD)
    for source, n in ((None, 17), ("a", 300), ("Z", 1), ("z", 16), ("é", 33)):
        rows += [(rnd.randrange(10**6), f"Text {source} {i}", None, source, i) for i in range(n)]
    rows += [(8, "same Row", "en", "hot", 8)] * 40  # one id and one text many times
    got = sorted(map(tuple, merkle.audit(odd(spark, rows), fan).collect()), key=repr)
    assert got == sorted(plain_audit(rows, fan), key=repr)
    assert {g[-1] for g in got} == {True, False}


def test_merkle_of_nothing_and_of_one_row(spark):
    assert merkle.audit(odd(spark, [])).collect() == []
    one = [(15, "Only", "en", None, 4)]
    assert [tuple(r) for r in merkle.audit(odd(spark, one)).collect()] == plain_audit(one)


def test_manifest_has_every_node_with_its_interval(spark):
    rows = [(i, "t", "en", f"s{i % 3}", 1) for i in range(100)]
    nodes = merkle.manifest(spark.createDataFrame(rows, DOCS), 4).collect()
    for scope, tree, n in (("source", "1s0", 34), ("source", "1s1", 33), ("dataset", "0", 3)):
        level, width = 0, 1
        while True:
            own = sorted((x["lo"], x["hi"]) for x in nodes if (x["scope"], x["source_tree"], x["level"]) == (scope, tree, level))
            assert own == [(a, min(a + width, n)) for a in range(0, n, width)]
            if len(own) == 1:
                break
            level, width = level + 1, width * 4


def plain_runs(w, least=24):
    out = {}
    for q in range(1, len(w) // 3 + 1):
        i = 0
        while i < len(w) - q:
            j = i
            while j < len(w) - q and w[j] == w[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, 3 * q):
                out.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted((a, n, q) for (a, n), q in out.items())


def some_texts(seed, count):
    rnd = random.Random(seed)
    for _ in range(count):
        w = []
        while len(w) < rnd.randint(0, 150):
            kind = rnd.random()
            if kind < 0.4:
                w += [rnd.choice("ab") for _ in range(rnd.randint(1, 10))]
            elif kind < 0.7:
                m = [rnd.choice("abc") for _ in range(rnd.randint(1, 12))]
                w += (m * 20)[:rnd.randint(len(m), len(m) * 8)]
            else:
                w += [str(rnd.randint(1000, 5000)) for _ in range(rnd.randint(1, 10))]
        yield [x.encode() for x in w]


def test_runs_equal_plain_python():
    texts = list(some_texts(1, 1200))
    found = periodic.runs_of(texts)
    for words, runs in zip(texts, found):
        assert [(r.start, r.length, r.period) for r in runs] == sorted(plain_runs(words), key=lambda r: (r[0], r[2]))
        gone = {i for r in runs for i in range(r.start + r.period, r.start + r.length)}
        assert periodic.collapse(words, runs) == [w for i, w in enumerate(words) if i not in gone]
    assert sum(map(len, found)) > 500


def plain_periodic(doc_id, text):
    words = re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode())
    n = len(words)
    if doc_id is not None and n and zlib.crc32(str(doc_id).encode()) % 10 == 0:
        g = zlib.crc32(str(doc_id).encode()) // 10
        a = g % n
        p = 1 + int((n - a) / (3 + g % 8))
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = sorted(plain_runs(words), key=lambda r: (r[0], r[2]))
    gone = {i for a, length, q in runs for i in range(a + q, a + length)}
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None, None, None))
    return (doc_id, len(runs), *best, best[0] is not None and best[1] * 1000 // best[2] or None, sha("".join(f"{a},{n},{q}\n" for a, n, q in runs)),
            hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in gone)).hexdigest())


def test_periodic_query_on_odd_and_planted_rows(spark):
    rows = [r for r in ODD if r[0] != 6] + [(i, " ".join(str(j * j % 997) for j in range(i % 90)), "en", "s", 1) for i in range(100, 600)]
    got = sorted(map(tuple, periodic.audit(odd(spark, rows)).collect()), key=repr)
    assert got == sorted((plain_periodic(r[0], r[1]) for r in rows), key=repr)
    assert sum(g[1] for g in got) > 5
    long = periodic.audit(odd(spark, ODD)).where("doc_id = 6").first()
    assert (long["n_runs"], long["start"], long["length"], long["period"]) == (1, 0, 30000, 1)
    assert periodic.audit(odd(spark, [])).collect() == []


def test_runs_table_and_collapsed_texts(spark):
    rows = [(1, "x " + "a b c " * 20 + "y", "en", "s", 1), (2, None, "en", "s", 1), (3, "plain\ntext", "en", "s", 1)]
    docs = spark.createDataFrame(rows, DOCS)
    assert [tuple(r) for r in periodic.periodic_runs(docs).collect()] == [(1, 1, 60, 3)]
    assert {r["doc_id"]: r["text"] for r in periodic.collapse_runs(docs).collect()} == {1: "x a b c y", 2: None, 3: "plain\ntext"}


def test_very_long_runs_and_long_fibonacci_words():
    a, b = [b"a"], [b"a", b"b"]
    while len(b) < 3000:
        a, b = b, b + a
    assert [(r.start, r.length, r.period) for r in periodic.runs_of([b])[0]] == sorted(plain_runs(b), key=lambda r: (r[0], r[2]))
    assert periodic.runs_of([[b"w"] * 300_000])[0] == [periodic.Run(0, 300_000, 1)]


def takes(items, text):
    """All ends that a template reaches from the start of a text, by plain recursion."""
    if not items:
        return {0}
    x, rest = items[0], items[1:]
    if isinstance(x, bytes):
        return {1 + e for e in takes(rest, text[1:])} if text[:1] == [x] else set()
    if isinstance(x, license.Free):
        return {k + e for k in range(x.least, min(x.most, len(text)) + 1) for e in takes(rest, text[k:])}
    return {e for way in x.ways for e in takes((*way, *rest), text)}


def test_automaton_equals_recursion():
    markup = [("one", 'a <<beginOptional>>b <<beginOptional>>c<<endOptional>> <<endOptional>>d'), ("two", 'b <<var;name="v";original="x; y";match=".{1,3}">> a'),
              ("three", 'c <<var;name="v";original="";match="a|b c|a a b">> d'), ("four", 'a <<var;name="v";match=".*">> a b')]
    made = license.Automaton.build([("base", "b c")], markup)
    parsed = [license.parse(m) for m in ("b c", *(m for _, m in markup))]
    rnd = random.Random(5)
    for _ in range(1500):
        text = [rnd.choice((b"a", b"b", b"c", b"d", b"zz")) for _ in range(rnd.randint(0, 14))]
        plain = sorted((i, t, i + max(ends)) for i in range(len(text)) for t, items in enumerate(parsed) if (ends := takes(items, text[i:])))
        assert sorted(made.places(text)) == plain


def test_templates_accept_their_own_wording_and_nothing_less():
    made = license.Automaton.build()
    for number, (label, markup) in enumerate(license.TEMPLATES, len(license.BASE)):
        original = re.sub(r"<<(begin|end)Optional>>", " ", re.sub(r'<<var;.*?original="(.*?)";match=.*?>>', r" \1 ", markup))
        text = license.words(f"Before. {original} After.".encode())
        assert number in {t for _, t, _ in made.places(text)}, label
        items = license.parse(markup)
        fixed = [i for i, w in enumerate(text) if w in {x for x in items if isinstance(x, bytes)}]
        broken = text[:fixed[-1]] + [b"otherwise"] + text[fixed[-1] + 1:]
        assert number not in {t for _, t, _ in made.places(broken)}, label


def test_license_query_on_odd_rows(spark):
    rows = ODD + [(20, "Released under the MIT License, UNDER THE MIT-LICENSE; CC BY-NC", "en", "s", 1), (21, "under thé MIT license İ", "en", "s", 1),
                  (22, "licensed under the GNU General Public License, version 3.", "en", "s", 1)]
    got = {r["doc_id"]: tuple(r)[1:] for r in license.annotate(odd(spark, rows)).collect() if r["doc_id"] is not None}
    assert got[20] == (12, 3, 1, 9, "cc-by-nc,mit", "cc-by-nc,mit", 0.5)
    assert got[21] == (5, 0, None, None, "", "", 0.0)
    assert got[22][1:6] == (0, None, None, "", "gpl-3") and 0.5 < got[22][6] < 1
    assert got[1] == got[2] == (0, 0, None, None, "", "", 0.0) and got[6][0] == 30000
    assert license.annotate(odd(spark, [])).collect() == []
    places = license.scan(odd(spark, rows)).where("doc_id = 20 and base").orderBy("start").collect()
    assert [(p["label"], p["start"], p["end"]) for p in places] == [("mit", 1, 5), ("mit", 5, 9), ("cc-by-nc", 9, 12)]


def test_markup_errors():
    for wrong in ("<<beginOptional>> a", "a <<endOptional>>", '<<var;name="x";match=".+">>'):
        with pytest.raises(ValueError):
            license.parse(wrong)
