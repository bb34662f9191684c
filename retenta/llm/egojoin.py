"""Cosine similarity join by epsilon grid order.

Unit vectors at cosine >= t lie within eps = sqrt(2 - 2t).  They are rotated so
that the leading principal dimensions come first, ordered by their grid cells
of width eps on those dimensions, and cut into tiles of consecutive vectors, a
tile into blocks.  Every interval has its bounding box; the join descends from
pairs of tiles to pairs of blocks and drops a pair as soon as its boxes, or the
balls around its blocks, are farther apart than eps.  The vectors of the
surviving block pairs are compared in single precision; pairs too close to the
threshold for that are decided in double precision.

Tiles meet in a nested-loop join whose tasks read two pieces of the written
tiles, so no vector is shuffled or stored once more for the tiles that it meets:
disk stays in proportion to the input however little the boxes prune.

Equal vectors collapse first.  A task adds up counts and labels of the vectors
of its two pieces and never reports pairs; blocks that lie as a whole within eps
of each other are linked without comparing vectors.  The number of tiles follows
the row count, so a dense region spreads over many tiles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from retenta.llm.common import chunks, merge_labels, release, table, valid_vectors
from retenta.llm.components import components

BLOCK = 512
TILE = 8            # blocks per tile at most
TILE_NUMBERS = 1 << 18  # components in a tile of several blocks at most
PART_BITS = 24      # room for tiles within one range partition
EDGES = 1 << 16     # edges between labels that a task holds before it passes them on
CLOSE = 1 << 20     # numbers multiplied at once where pairs are decided in double precision
DIMS = 8            # leading principal dimensions
PCA_SAMPLE = 4096   # vectors the rotation is fitted on; any rotation gives the same links


def _matrix(cells, dim: int) -> np.ndarray:
    return np.array([np.asarray(c, dtype=np.float64) for c in cells]).reshape(-1, dim)


def _unit(v: np.ndarray) -> np.ndarray:
    top = np.abs(v).max(axis=1, keepdims=True)  # huge or tiny components must not overflow the norm
    v = v / top
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def _rotation(classes: DataFrame, dim: int, dims: int) -> np.ndarray:
    rows = classes.orderBy(F.xxhash64("rep"), "rep").select("embedding").limit(PCA_SAMPLE).collect()
    unit = _unit(_matrix([r[0] for r in rows], dim)) if rows else np.eye(dim)
    spread = unit - unit.mean(axis=0)
    _, vectors = np.linalg.eigh(spread.T @ spread)
    return np.ascontiguousarray(vectors[:, ::-1][:, :dims])


def _tiles(classes: DataFrame, dim: int, eps: float, size: int) -> DataFrame:
    """(tile, reps, weights, vectors, boxes, lo, hi): consecutive vectors of the epsilon grid order.

    `boxes` holds the lower and upper corners of the tile's blocks, `lo` and `hi` those of the tile.
    """
    dims = min(DIMS, dim)
    basis = _rotation(classes, dim, dims)
    kind = _kind(classes)
    most = size * max(1, min(TILE, TILE_NUMBERS // (size * dim)))

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                v = b.column(2).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
                cells = np.floor(_unit(v) @ basis / eps).astype(np.int32)
                raw = pa.array([r.tobytes() for r in v.astype(kind)], pa.binary())
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), raw, *map(pa.array, cells.T)],
                                                 ["rep", "weight", "raw", *(f"c{j}" for j in range(dims))])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, k = TaskContext.get().partitionId(), 0
        held: list[pa.RecordBatch] = []
        count = 0
        for b in batches:
            while b.num_rows:
                piece = b.slice(0, most - count)
                b = b.slice(piece.num_rows)
                held.append(piece)
                count += piece.num_rows
                if count == most:
                    yield emit(held, (part << PART_BITS) + k)
                    held, count, k = [], 0, k + 1
        if count:
            yield emit(held, (part << PART_BITS) + k)

    def emit(held: list[pa.RecordBatch], tile: int) -> pa.RecordBatch:
        t = pa.Table.from_batches(held)
        raw = b"".join(t.column(2).to_pylist())
        p = _unit(np.frombuffer(raw, kind).astype(np.float64).reshape(-1, dim)) @ basis
        starts = np.arange(0, len(p), size)
        boxes = np.stack([np.minimum.reduceat(p, starts), np.maximum.reduceat(p, starts)])
        flat = lambda x: pa.array([x], pa.binary())
        return pa.RecordBatch.from_arrays(
            [pa.array([tile]), flat(t.column(0).to_numpy().tobytes()), flat(t.column(1).to_numpy().tobytes()), flat(raw),
             flat(boxes.tobytes()), pa.array([boxes[0].min(axis=0).tolist()]), pa.array([boxes[1].max(axis=0).tolist()])],
            ["tile", "reps", "weights", "vectors", "boxes", "lo", "hi"])

    cells = [f"c{j}" for j in range(dims)]
    rows = classes.select("rep", "weight", "embedding").mapInArrow(
        project, "rep long, weight long, raw binary, " + ", ".join(f"{c} int" for c in cells))
    parts = chunks(classes.count(), size * TILE << 1)
    dealt = rows.repartitionByRange(parts, *cells, "rep").sortWithinPartitions(*cells, "rep")
    return table(dealt.mapInArrow(cut, "tile long, reps binary, weights binary, vectors binary, boxes binary, lo array<double>, hi array<double>"),
                 "tiles")


def _kind(classes: DataFrame) -> str:
    """numpy's name of the type that holds the vectors' components as they are."""
    return "f4" if classes.schema["embedding"].dataType.elementType.typeName() == "float" else "f8"


def _near(eps: float, dims: int) -> Column:
    """Condition: the boxes of tiles A and B are within eps."""
    gaps = [F.greatest(F.col("A.lo")[j] - F.col("B.hi")[j], F.col("B.lo")[j] - F.col("A.hi")[j], F.lit(0.0)) for j in range(dims)]
    return sum((g * g for g in gaps), F.lit(0.0)) <= eps * eps * (1 + 1e-9)


class _Tile:
    """Unit vectors of a tile in both precisions, with boxes, centres and radii of its blocks."""

    def __init__(self, vectors: bytes, boxes: bytes, weights: bytes, kind: str, dim: int, dims: int, size: int):
        self.unit = _unit(np.frombuffer(vectors, kind).astype(np.float64).reshape(-1, dim))
        self.short = self.unit.astype(np.float32)
        self.weights = np.frombuffer(weights, np.int64)
        self.low, self.high = np.frombuffer(boxes).reshape(2, -1, dims)
        self.blocks = [slice(i, min(i + size, len(self.unit))) for i in range(0, len(self.unit), size)]
        self.centres = np.array([self.unit[b].mean(axis=0) for b in self.blocks])
        self.radii = np.array([np.sqrt(((self.unit[b] - c) ** 2).sum(axis=1).max()) for b, c in zip(self.blocks, self.centres)])


class _Found:
    """Links and labels of a tile's vectors, as far as a task has seen; a label is a rep that the vector reaches."""

    def __init__(self, reps: bytes):
        self.reps = np.frombuffer(reps, np.int64)
        self.labels, self.links = self.reps.copy(), np.zeros(len(self.reps), np.int64)


def _linked(u: np.ndarray, v: np.ndarray, su: np.ndarray, sv: np.ndarray, cosine: float) -> np.ndarray | None:
    """Mask of the pairs at cosine >= `cosine`, None without any; su and sv are u and v in single precision."""
    slack = (u.shape[1] + 8) * 2.0 ** -23  # more than single precision can be wrong by
    cos = su @ sv.T
    if cos.max() < cosine - slack:
        return None
    mask = cos >= cosine + slack
    rows, cols = np.nonzero((cos >= cosine - slack) & ~mask)
    step = max(1, CLOSE // u.shape[1])
    for i in range(0, len(rows), step):
        r, c = rows[i:i + step], cols[i:i + step]
        mask[r, c] = (u[r] * v[c]).sum(axis=1) >= cosine
    return mask


def _compare(pairs: DataFrame, kind: str, dim: int, cosine: float, eps: float, size: int) -> DataFrame:
    """Links of the vectors of all pairs of tiles: (rep, links, root), several rows a rep.

    A row without links says that rep and root reach one another.
    """
    dims = min(DIMS, dim)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, _Found] = {}
        edges: list[np.ndarray] = []
        held, a_id, a = 0, None, None
        for batch in batches:
            at = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            part = lambda side, i: [at[f"{side}_{x}"][i].as_py() for x in ("vectors", "boxes", "weights")]
            for i in range(batch.num_rows):
                ids = at["a"][i].as_py(), at["b"][i].as_py()
                if ids[0] != a_id:  # a tile comes with all its partners in turn
                    a_id, a = ids[0], _Tile(*part("a", i), kind, dim, dims, size)
                b = a if ids[1] == a_id else _Tile(*part("b", i), kind, dim, dims, size)
                for side, t in zip("ab", ids):
                    if t not in found:
                        found[t] = _Found(at[f"{side}_reps"][i].as_py())
                for e in meet(a, b, found[ids[0]], found[ids[1]]):
                    edges.append(e)
                    held += e.shape[1]
                if held >= EDGES:
                    yield rows(*np.unique(np.concatenate(edges, axis=1), axis=1))
                    edges, held = [], 0
        if edges:
            yield rows(*np.unique(np.concatenate(edges, axis=1), axis=1))
        for f in found.values():
            some = np.flatnonzero(f.links)
            if len(some):
                yield rows(f.reps[some], f.reps[some], f.links[some])

    def rows(reps: np.ndarray, roots: np.ndarray, links: np.ndarray | None = None) -> pa.RecordBatch:
        links = np.zeros(len(reps), np.int64) if links is None else links
        return pa.RecordBatch.from_arrays([pa.array(reps), pa.array(links), pa.array(roots)], ["rep", "links", "root"])

    def meet(a: _Tile, b: _Tile, fa: _Found, fb: _Found) -> Iterator[np.ndarray]:
        """Adds the links between two tiles to what was found; yields (label, smaller label) edges."""
        gap = np.maximum(np.maximum(a.low[:, None] - b.high[None], b.low[None] - a.high[:, None]), 0.0)
        apart = np.sqrt(((a.centres[:, None] - b.centres[None]) ** 2).sum(axis=2))
        reach = a.radii[:, None] + b.radii[None]
        near = ((gap * gap).sum(axis=2) <= eps * eps * (1 + 1e-9)) & (apart - reach <= eps + 1e-6)
        whole = apart + reach <= eps - 1e-6
        for i, j in np.argwhere(near):
            if a is b and j < i:
                continue
            same = a is b and i == j
            x, y = a.blocks[i], b.blocks[j]
            if whole[i, j]:
                fa.links[x] += b.weights[y].sum() - (a.weights[x] if same else 0)
                if not same:
                    fb.links[y] += a.weights[x].sum()
                yield from relabel(fa, fb, x, y, None)
                continue
            mask = _linked(a.unit[x], b.unit[y], a.short[x], b.short[y], cosine)
            if mask is None:
                continue
            if same:
                np.fill_diagonal(mask, False)
            r, c = np.flatnonzero(mask.any(axis=1)), np.flatnonzero(mask.any(axis=0))
            if len(r):
                mask = mask[np.ix_(r, c)]
                r, c = r + x.start, c + y.start
                fa.links[r] += mask @ b.weights[c]
                if not same:
                    fb.links[c] += a.weights[r] @ mask
                yield from relabel(fa, fb, r, c, mask)

    def relabel(fa: _Found, fb: _Found, r, c, mask: np.ndarray | None) -> Iterator[np.ndarray]:
        """Smallest labels over the links of a block pair, all links where mask is None; yields what changed."""
        left, right = fa.labels[r], fb.labels[c]
        least = min(left.min(), right.min())
        if left.max() == least and right.max() == least:
            return
        new = (np.full_like(left, least), np.full_like(right, least)) if mask is None else merge_labels(mask, left, right)
        for f, at, old, now in ((fa, r, left, new[0]), (fb, c, right, new[1])):
            moved = old != now
            if moved.any():
                yield np.unique(np.stack([old[moved], now[moved]]), axis=1)
                f.labels[at] = np.minimum(f.labels[at], now)

    return pairs.mapInArrow(compare, "rep long, links long, root long")


def similarity_join(vectors: DataFrame, cosine: float = 0.9, id_col: str = "vec_id", vec_col: str = "embedding",
                    block: int = BLOCK) -> DataFrame:
    """One row per input row: vec_id, n_links, component_id, kept.

    n_links counts the other vectors at cosine >= `cosine`; component_id is the
    smallest id reachable over such links; kept marks vec_id = component_id.
    Vectors that are null, empty, zero, or hold null or non-finite components
    link with nothing.  Vectors of different lengths do not link; those of one
    length are compared among themselves, one join per length.  A row without
    an id links with nothing: component_id null, kept false.  Rows that repeat
    an id with the same vector link like different rows; rows that give one id
    several vectors of one length share their links and component.  An empty
    table gives an empty one; other columns are ignored.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("embedding"))
    rows = rows.withColumn("ok", valid_vectors(rows) & F.col("vec_id").isNotNull())
    # an embedding model has one length, so lengths are few
    lengths = sorted(r[0] for r in rows.where("ok").select(F.size("embedding")).distinct().collect())
    out = rows.where(~F.col("ok")).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    for dim in lengths:
        sound = rows.where(F.col("ok") & (F.size("embedding") == dim)).select("vec_id", "embedding")
        out = _links_of_length(sound, dim, cosine, block).unionByName(out)
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def _links_of_length(sound: DataFrame, dim: int, cosine: float, block: int) -> DataFrame:
    """(vec_id, n_links, component_id) of valid vectors of one length."""
    classes = table(sound.groupBy("embedding").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("weight")), "classes")
    members = table(sound.join(classes, "embedding").select("vec_id", "rep", "weight"), "members")  # no later step carries the vectors
    eps = float(np.sqrt(2 - 2 * cosine))
    tiles = _tiles(classes, dim, eps, block)
    kind = _kind(classes)
    release(classes)
    one, other = tiles.alias("A"), tiles.alias("B").hint("shuffle_replicate_nl")  # Spark's name for reading both sides anew in every task
    pairs = one.join(other, (F.col("A.tile") <= F.col("B.tile")) & _near(eps, min(DIMS, dim))).select(
        F.col("A.tile").alias("a"), F.col("B.tile").alias("b"),
        *(F.col(f"{s}.{x}").alias(f"{s.lower()}_{x}") for s in "AB" for x in ("reps", "weights", "vectors", "boxes")))
    found = table(_compare(pairs, kind, dim, cosine, eps, block), "found")
    release(tiles)
    counts = found.groupBy("rep").agg(F.sum("links").alias("links"))
    member = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    return members.join(counts, "rep", "left").join(member.withColumnRenamed("id", "rep"), "rep", "left").select(
        "vec_id", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
