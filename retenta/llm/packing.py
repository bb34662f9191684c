"""Cost-balanced packing of tokenised documents into sequences.

Documents are tokenised once and spread over groups of bounded size.  In a
group, pieces of a full sequence stand alone; what remains of the documents is
assigned in descending length to the sequence of lowest estimated attention
cost (linear plus quadratic in the piece length) that still has room, and is
cut only where none has.  A group's sequences have exactly its tokens as
capacity: full ones, and powers of two for the rest, so nothing is padded.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from retenta.llm.common import chunks

LENGTH = 2048
END = 1
GROUP = 4096      # documents per group
LINEAR, QUADRATIC = 1.0, 1.0 / 2048


class Encoder:
    """A byte-level BPE vocabulary file of the tokenizers library: its ids, run by tiktoken (several times as fast) where both agree.

    A text that holds one of the file's added tokens goes to tokenizers as a
    whole, and so does one on which tiktoken gives up (a million blanks in a row).
    """

    def __init__(self, path: str, pattern: str) -> None:
        import tiktoken

        with open(path, encoding="utf-8") as f:
            content = json.load(f)
        vocab, added = content["model"]["vocab"], content.get("added_tokens") or []
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves; the others follow from 256 on
        hidden = [b for b in range(256) if b not in set(shown)]
        byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
        ranks = {bytes(byte_of[c] for c in token): i for token, i in vocab.items()}
        self.path, self.added = path, [t["content"] for t in added]
        self.n_vocab = 1 + max([*vocab.values(), *(t["id"] for t in added)])
        self.fast = tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    @cached_property
    def whole(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def encode(self, text: str) -> list[int]:
        if not any(t in text for t in self.added):
            try:
                return self.fast.encode_ordinary(text)
            except BaseException as e:  # a panic of tiktoken's Rust code is no Exception, and its class has no public name
                if type(e).__name__ != "PanicException":
                    raise
        return self.whole.encode(text, add_special_tokens=False).ids


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> Encoder:
    return Encoder(path, pattern)


def tokenized(docs: DataFrame, path: str, pattern: str, end: int = END) -> DataFrame:
    """(doc_id, n, ids): token ids with the end id, as little-endian 16-bit numbers (32-bit for larger vocabularies)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, pattern)
        kind = "<u2" if enc.n_vocab <= 1 << 16 else "<u4"
        for b in batches:
            ids = [np.array([*enc.encode(t.as_py() or ""), end], dtype=kind) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(x) for x in ids], pa.int64()), pa.array([kind] * len(ids), pa.string()),
                 pa.array([x.tobytes() for x in ids], pa.binary()), b.column(2)], ["doc_id", "n", "kind", "ids", "pack_group"])

    return docs.mapInArrow(run, "doc_id long, n long, kind string, ids binary, pack_group long")


def assign(lengths: np.ndarray, length: int = LENGTH, linear: float = LINEAR, quadratic: float = QUADRATIC) -> pd.DataFrame:
    """Pieces of one group of documents: doc, start, length, sequence, offset."""
    out: list[tuple[int, int, int, int, int]] = []
    full, rest = lengths // length, lengths % length
    seq = 0
    for d in np.flatnonzero(full):
        out.extend((d, k * length, length, seq + k, 0) for k in range(full[d]))
        seq += int(full[d])
    total = int(rest.sum())
    room = np.array([length] * (total // length) + [1 << b for b in range(length.bit_length(), -1, -1) if (total % length) >> b & 1])
    used, cost = np.zeros(len(room), np.int64), np.zeros(len(room))
    for d in np.argsort(-rest, kind="stable"):
        start, left = int(full[d]) * length, int(rest[d])
        while left:
            fits = np.where(room >= left, cost, np.inf)
            k = int(fits.argmin())
            take = left
            if fits[k] == np.inf:
                k = int(room.argmax())
                take = int(room[k])
            out.append((d, start, take, seq + k, int(used[k])))
            used[k] += take
            room[k] -= take
            cost[k] += linear * take + quadratic * take * take
            start, left = start + take, left - take
    return pd.DataFrame(out, columns=["doc", "start", "length", "sequence", "offset"])


def pack(docs: DataFrame, path: str, pattern: str, length: int = LENGTH, end: int = END, group: int = GROUP) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Null and empty texts are documents of the end id alone.  Rows with a null
    or repeated doc_id are packed like any other.  Very long texts are cut into
    as many pieces as they need.  An empty table gives an empty one; other
    columns are ignored.
    """
    groups = chunks(docs.count(), group)
    deal = F.pmod(F.xxhash64("doc_id", F.monotonically_increasing_id()), F.lit(groups)).cast("long")
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", deal.alias("pack_group"))

    def run(rows: pa.Table) -> pa.Table:
        n = rows["n"].to_numpy()
        pieces = assign(n, length)
        doc, begin, size = (pieces[c].to_numpy() for c in ("doc", "start", "length"))
        ids = [np.frombuffer(x.as_buffer(), dtype=k.as_py()) for x, k in zip(rows["ids"], rows["kind"])]
        crc = [zlib.crc32(ids[d][s:s + m].astype("<u4").tobytes()) for d, s, m in zip(doc, begin, size)]
        first = rows["pack_group"][0].as_py() << 24
        return pa.table({
            "doc_id": rows["doc_id"].take(pa.array(doc, pa.int64())), "start": pa.array(begin, pa.int64()), "length": pa.array(size, pa.int64()),
            "ids_crc32": pa.array(crc, pa.int64()), "doc_tokens": pa.array(n[doc], pa.int64()),
            "sequence_id": pa.array(first + pieces["sequence"].to_numpy(), pa.int64()), "offset": pa.array(pieces["offset"].to_numpy(), pa.int64())})

    return tokenized(slim, path, pattern, end).groupBy("pack_group").applyInArrow(
        run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
