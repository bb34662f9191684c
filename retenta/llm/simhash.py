"""SimHash near-duplicates through a segment-popcount embedding.

A fingerprint of 64 bits becomes 32 counts, the set bits of its 2-bit segments.
The Manhattan distance of two count vectors is a lower bound of the Hamming
distance.  A grid with cells of width one over each half of the vector finds
the candidates: at Manhattan distance 3 or less, one half is at distance 1 or
less, so one fingerprint lies in the other's cell or in a cell next to it.  A
fingerprint stands once in its own cell of each half and once in every cell
with one count more (the smaller of two neighbours does the probing), 26 rows
on average.  Candidates are verified by Hamming distance.

Equal fingerprints collapse before the join.  A cell with many fingerprints is
cut into chunks whose pairs are spread over the tasks, and a task reports a
spanning forest of the links it finds in a cell, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from retenta.llm.common import partitions, release, table
from retenta.llm.components import components

SHINGLE = 3
SEED = 42
MAX_BITS = 3
CHUNK = 2048
_BITS = np.array([[(b >> i) & 1 for i in range(8)] for b in range(256)], dtype=np.int64)


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """64-bit SimHash of one text: word shingles, lower-cased A-Z, XXH64; 0 without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    k = min(shingle, len(words))
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    n = len(words) - k + 1
    hashes = np.fromiter((digest(joined[s:e], seed) for s, e in zip(starts[:n].tolist(), ends[k - 1:].tolist())), np.uint64, n)
    per_byte = hashes.astype("<u8").view(np.uint8).reshape(n, 8)
    counts = np.concatenate([np.bincount(per_byte[:, j], minlength=256) @ _BITS for j in range(8)])
    return int(np.packbits((2 * counts > n).astype(np.uint8), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp long) for every row; null and blank texts have fingerprint 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t.as_py()) for t in b.column(1)], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps, pa.int64())], ["doc_id", "fp"])

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return slim.mapInArrow(run, "doc_id long, fp long")


def _cells(fps: DataFrame) -> DataFrame:
    """(cell, probe, fp): own cells of both halves (probe false) and their upper neighbours."""
    places = []
    for half in (0, 1):
        bits = F.shiftrightunsigned("fp", 32 * half).bitwiseAND(F.lit(0xFFFFFFFF))
        key = bits - F.shiftright(bits, 1).bitwiseAND(F.lit(0x55555555))  # popcounts of 2-bit segments, side by side
        cell = key + F.lit(half << 32)
        places.append(F.struct(cell.alias("cell"), F.lit(False).alias("probe")))
        for j in range(16):
            room = F.shiftrightunsigned(key, 2 * j).bitwiseAND(F.lit(3)) < 2
            places.append(F.when(room, F.struct((cell + F.lit(1 << (2 * j))).alias("cell"), F.lit(True).alias("probe"))))
    return fps.select("fp", F.explode(F.array(*places)).alias("p")).where("p is not null").select("p.cell", "p.probe", "fp")


def _forest(fp: np.ndarray, homes: int, max_bits: int, out: list[tuple[int, int]]) -> None:
    """Spanning forest of the links of one cell; the first `homes` rows live in it."""
    label = np.arange(len(fp))
    for i in range(homes):
        near = np.flatnonzero(np.bitwise_count(fp ^ fp[i]) <= max_bits)
        found, first = np.unique(label[near], return_index=True)
        if len(found) > 1:
            out.extend((fp[i], fp[near[f]]) for f, t in zip(first, found) if t != label[i])
            label[np.isin(label, found)] = found[0]


def _cell_links(batches: Iterator[pa.RecordBatch], max_bits: int) -> Iterator[pa.RecordBatch]:
    """Links inside the cells of a partition sorted by (cell, part, probe).

    Only the home rows of the cell at a batch's end are carried to the next.
    """
    held = [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool), np.empty(0, np.uint64)]
    for b in batches:
        cols = [b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_numpy(zero_copy_only=False),
                b.column(2).to_numpy(zero_copy_only=False).astype(bool), b.column(3).to_numpy(zero_copy_only=False).view(np.uint64)]
        cell, part, probe, fp = (np.concatenate(x) for x in zip(held, cols))
        if not len(fp):
            continue
        turn = np.flatnonzero((cell[1:] != cell[:-1]) | (part[1:] != part[:-1])) + 1
        begin, end = np.concatenate([[0], turn]), np.concatenate([turn, [len(fp)]])
        homes = np.add.reduceat((~probe).astype(np.int64), begin)
        size = end - begin
        out: list[tuple[int, int]] = []
        wide = (size > 24) & (homes > 0)
        for k in np.flatnonzero(wide):
            _forest(fp[begin[k]:end[k]], int(homes[k]), max_bits, out)
        group = np.repeat(np.arange(len(begin)), size)
        row = np.flatnonzero(~probe & ~wide[group])
        step = 1
        while len(row):
            row = row[(row + step < len(fp))]
            row = row[group[row + step] == group[row]]
            hit = row[np.bitwise_count(fp[row] ^ fp[row + step]) <= max_bits]
            out.extend(zip(fp[hit], fp[hit + step]))
            step += 1
        ends = np.array(out, dtype=np.uint64).reshape(-1, 2).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], ["a", "b"])
        last = np.arange(begin[-1], len(fp))
        last = last[~probe[last]]
        held = [cell[last], part[last], probe[last], fp[last]]


def fingerprint_links(fps: DataFrame, max_bits: int = MAX_BITS, chunk: int = CHUNK) -> DataFrame:
    """Distinct fingerprints (fp) -> links (a, b) that span every group within max_bits <= 3 bits."""
    if max_bits > 3:
        raise ValueError("the grid covers distances up to 3")
    rows = _cells(fps)
    own = rows.where(~F.col("probe")).groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
    hot = own.where(F.col("n") > chunk).select("cell", F.ceil(F.col("n") / chunk).cast("int").alias("c"))
    c = F.coalesce("c", F.lit(1))
    mine = F.pmod(F.xxhash64("fp"), c).cast("int")
    other = F.sequence(F.lit(0), c - 1)
    # homes meet in all pairs of chunks; a probe meets each chunk once
    part = F.when(F.col("probe"), F.transform(other, lambda j: j * c + j)).otherwise(
        F.transform(other, lambda j: F.least(mine, j) * c + F.greatest(mine, j)))
    spread = rows.join(hot, "cell", "left").select("cell", F.explode(part.cast("array<long>")).alias("part"), "probe", "fp")
    n = partitions(fps.sparkSession)
    dealt = spread.repartition(n, "cell", "part").sortWithinPartitions("cell", "part", "probe")
    return dealt.mapInArrow(lambda batches: _cell_links(batches, max_bits), "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 hex digits), component_id.

    Fingerprints link at 3 or fewer differing bits; component_id is the
    smallest doc_id reachable.  Null and blank texts have fingerprint zero and
    link like any other.  Texts count whole, whatever their length.  A null
    doc_id takes part but is never the smallest id.  Repeated rows stay rows of
    their own.  An empty table gives an empty one; other columns are ignored.
    """
    by_doc = table(fingerprints(docs, id_col, text_col), "fingerprints")
    distinct = table(by_doc.groupBy("fp").agg(F.min("doc_id").alias("smallest")), "distinct")
    linked = components(fingerprint_links(distinct.select("fp")))
    member = linked.select(F.col("id").alias("fp"), F.col("component").alias("root"))
    groups = table(distinct.join(member, "fp", "left").select("fp", "smallest", F.coalesce("root", "fp").alias("root")), "groups")
    least = groups.groupBy("root").agg(F.min("smallest").alias("component_id"))
    named = groups.join(least, "root").select("fp", "component_id")
    return by_doc.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """Documents that are the smallest id of their group; a repeated doc_id stays once.

    Rows without a doc_id stay, since no group can name them.
    """
    found = near_duplicates(docs)
    stay = found.where(F.col("doc_id") == F.col("component_id")).select("doc_id").distinct()
    kept = docs.join(stay, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return kept.select(docs.columns).unionByName(docs.where(F.col("doc_id").isNull()))
