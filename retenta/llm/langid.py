"""Language identification by bit-sliced Bloom filters over character 3-grams.

One table of bit masks serves all languages: bit l of a slot belongs to
language l's filter, so the AND of an n-gram's slots gives every language that
contains it.  A language contains an n-gram that makes up a large enough share
of its text, next to the language where the share is largest.  A text counts,
per language, the n-grams its filter answers yes to; the expected number of
false positives is taken off, and the largest corrected count decides.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from retenta.llm.common import remainder, sample_share, sampled

UNKNOWN = "und"
SAMPLE = 1500        # training documents per language
SLOTS = 1 << 18
HASHES = 3
LEAST_SHARE = 2e-5   # of a language's n-grams; bounds the n-grams kept per language by 1 / LEAST_SHARE
LEAST_RATIO = 0.3    # of the largest share that any language has
STEP = 1 << 20       # characters handled at once
SEED = 42


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def grams(text: str) -> Iterator[np.ndarray]:
    """Character 3-grams of a lower-cased text, as exact 63-bit numbers; what is no letter counts as a space."""
    letters = _letters()
    for at in range(0, len(text), STEP):
        part = (" " + text[at:at + STEP] + " ") if len(text) <= STEP else " " + text[at:at + STEP + 1] + " "
        code = np.frombuffer(part.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
        code = np.where(letters[code], code, 0)
        found = code[:-2] | (code[1:-1] << np.uint64(21)) | (code[2:] << np.uint64(42))
        yield found[code[1:-1] != 0]


def _slots(gram: np.ndarray, slots: int, hashes: int) -> np.ndarray:
    x = gram * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(29)
    step = (x >> np.uint64(32)) | np.uint64(1)
    return np.stack([(x + np.uint64(i) * step) % np.uint64(slots) for i in range(hashes)]).astype(np.int64)


@dataclass
class LanguageFilters:
    languages: list[str]
    table: np.ndarray  # (slots, words of 64 languages)
    wrong: np.ndarray  # expected false-positive rate per language
    hashes: int = HASHES

    @classmethod
    def build(cls, languages: list[str], contents: list[np.ndarray], slots: int = SLOTS, hashes: int = HASHES) -> "LanguageFilters":
        table = np.zeros((slots, max(1, -(-len(languages) // 64))), np.uint64)
        for i, gram in enumerate(contents):
            table[_slots(gram, slots, hashes).ravel(), i // 64] |= np.uint64(1 << (i % 64))
        fill = np.array([((table[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)).mean() for i in range(len(languages))])
        return cls(languages, table, fill ** hashes, hashes)

    def counts(self, text: str) -> tuple[int, np.ndarray]:
        """Number of n-grams, and for each language those it contains, corrected for false positives."""
        n, yes = 0, np.zeros(len(self.languages))
        for gram in grams(text):
            place = _slots(gram, len(self.table), self.hashes)
            mask = self.table[place[0]]
            for p in place[1:]:
                mask = mask & self.table[p]
            n += len(gram)
            yes += [((mask[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)).sum() for i in range(len(self.languages))]
        return n, np.maximum(0.0, (yes - n * self.wrong) / np.maximum(1e-9, 1.0 - self.wrong))

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and its share of all corrected counts; `und` without letters, the first language where nothing is known."""
        n, count = self.counts(text) if text and self.languages else (0, np.zeros(0))
        if not n:
            return UNKNOWN, 0.0
        best = int(count.argmax())
        return self.languages[best], float(count[best] / count.sum()) if count.sum() else 0.0

    def recognised(self, text: str | None) -> float:
        """The share of a text's own n-grams that its language contains; other languages, however many, do not lower it."""
        n, count = self.counts(text) if text and self.languages else (0, np.zeros(0))
        return float(count.max() / n) if n else 0.0


def fit(docs: DataFrame, sample: int = SAMPLE, seed: int = SEED) -> LanguageFilters:
    """Filters from (doc_id, text, lang); uses about `sample` documents of each language, whole texts.

    Rows without id, text or lang teach nothing.
    """
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    have = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(have)
    share = F.coalesce(*(F.when(F.col("lang") == v, sample_share(have[v], sample)) for v in languages), F.lit(0.0))
    number = {v: i for i, v in enumerate(languages)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for text, lang in zip(b.column(0), b.column(1)):
                for gram in grams(text.as_py()):
                    own, n = np.unique(gram, return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(own), number[lang.as_py()], np.int32)), pa.array(own.view(np.int64)), pa.array(n, pa.int64())],
                        ["l", "gram", "n"])

    rows = known.where(sampled(F.col("doc_id"), share, seed)).select("text", "lang")
    total = rows.mapInArrow(count, "l int, gram long, n long").groupBy("l", "gram").agg(F.sum("n").alias("n"))
    # one row per language, as in `have`; a window would put all n-grams of a language into one task
    sizes = total.groupBy("l").agg(F.sum("n").alias("size"))
    shares = total.join(F.broadcast(sizes), "l").withColumn("share", F.col("n") / F.col("size"))
    kept = shares.where(F.col("share") >= LEAST_SHARE).withColumn("most", F.max("share").over(_by("gram")))
    found = kept.where(F.col("share") >= LEAST_RATIO * F.col("most")).select("l", "gram").toPandas()
    return LanguageFilters.build(languages, [found["gram"][found["l"] == i].to_numpy().astype(np.int64).view(np.uint64) for i in range(len(languages))])


def _by(col: str):
    from pyspark.sql import Window

    return Window.partitionBy(col)


def annotate(docs: DataFrame, model: LanguageFilters) -> DataFrame:
    """(doc_id, lang_pred, score) for every row, from the whole text alone."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [shared.value.predict(t.as_py()) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())],
                ["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, lang_pred string, score double")


def train_rows(docs: DataFrame) -> DataFrame:
    """Documents whose crc32(doc_id as text) modulo 4 is not 2."""
    return docs.where(remainder(F.col("doc_id"), 4) != 2)


def identify(docs: DataFrame) -> DataFrame:
    """One row per input row: doc_id, held_out, lang_pred, score.

    Null texts and texts without a letter get `und` and score 0; so does every
    text when no row teaches a language.  Ties go to the smaller language
    value.  A null doc_id is never trained on and not held out.  Repeated rows
    stay; an empty table gives an empty one; other columns are ignored.
    """
    found = annotate(docs, fit(train_rows(docs)))
    return found.select("doc_id", F.coalesce(remainder(F.col("doc_id"), 4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


def reject_unknown(docs: DataFrame, least: float = 0.3) -> DataFrame:
    """Documents, with all their columns, of whose n-grams a share of `least` or more belongs to the predicted language.

    The filters learn from the documents' own lang column.  Two values of it
    for one language do no harm: both contain the same n-grams.
    """
    model = docs.sparkSession.sparkContext.broadcast(fit(docs))

    @F.pandas_udf("boolean")
    def known(text):
        import pandas as pd

        return pd.Series([model.value.recognised(t) >= least for t in text], dtype=bool)

    return docs.where(known("text"))
