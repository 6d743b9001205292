"""Byte-level BPE encoding and decoding with a two-tier lookup.

Tier one: a minimal perfect hash over the vocabulary's byte strings (a
cascade of bit arrays, Limasset et al. 2017) resolves every pre-token that is
itself in the vocabulary, for a whole batch at once. Tier two: the other
pre-tokens are merged with a heap of (rank, position) over a doubly linked
list of their bytes, O(n log n) in the pre-token's length.

Defined results: NULL text encodes to no ids, as the empty text does; each
match of the pattern is encoded by itself; no special tokens; texts of any
length are encoded whole; ``decode`` of ``encode`` gives the text's UTF-8
bytes; extra columns stay; repeated and tied rows are ordinary rows.
"""

from __future__ import annotations

import base64
import heapq
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def _mix(h: np.ndarray, level: int) -> np.ndarray:
    """A 64-bit finaliser, different for every level."""
    h = h ^ np.uint64((0x9E3779B97F4A7C15 * (level + 1)) & 0xFFFFFFFFFFFFFFFF)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class PerfectHash:
    """Minimal perfect hash: each of n keys gets its own number below n; other hashes get any number or -1."""

    def __init__(self, hashes: np.ndarray, load: float = 1.7):
        if len(np.unique(hashes)) != len(hashes):
            raise ValueError("two keys share a 64-bit hash")
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        left, placed = hashes, 0
        while len(left):
            size = int(len(left) * load) + 1
            at = (_mix(left, len(self.levels)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            number = np.cumsum(alone) - 1 + placed
            self.levels.append((alone, number))
            placed += int(alone.sum())
            left = left[~alone[at]]

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        out = np.full(len(hashes), -1, dtype=np.int64)
        open_ = np.arange(len(hashes))
        for k, (alone, number) in enumerate(self.levels):
            at = (_mix(hashes[open_], k) % np.uint64(len(alone))).astype(np.int64)
            hit = alone[at]
            out[open_[hit]] = number[at[hit]]
            open_ = open_[~hit]
            if not len(open_):
                break
        return out


def merge_bytes(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Byte-pair merges of one pre-token: lowest rank first, leftmost first among equal ranks."""
    n, get = len(piece), ranks.get
    bits = n.bit_length()
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    pair = [(get(piece[i : i + 2], -1) << bits) + i for i in range(n)]  # rank and place of the pair that begins at a part
    pair[n - 1 :] = [-1]
    heap = [p for p in pair if p >= 0]
    heapq.heapify(heap)
    while heap:
        p = heapq.heappop(heap)
        i = p & (1 << bits) - 1
        if pair[i] != p:
            continue  # one of the two parts has grown since
        j = after[i]
        k = after[i] = after[j]
        pair[i] = pair[j] = -1
        if k < n:
            before[k] = i
            if (r := get(piece[i : after[k]])) is not None:
                pair[i] = r << bits | i
                heapq.heappush(heap, pair[i])
        if (h := before[i]) >= 0:
            pair[h] = -1
            if (r := get(piece[h:k])) is not None:
                pair[h] = r << bits | h
                heapq.heappush(heap, pair[h])
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : after[i]]])
        i = after[i]
    return out


class Encoder:
    """Encodes texts; resolved pre-tokens are kept in a memo of at most ``limit`` entries (or one batch's), and the memo before
    it, so that a pre-token that comes again and again is merged once."""

    def __init__(self, rank_path: str, pattern: str, limit: int = 200_000):
        import regex
        import xxhash

        self.hash = xxhash.xxh3_64_intdigest
        self.find = regex.compile(pattern).findall
        self.ranks = read_ranks(rank_path)
        tokens = list(self.ranks)
        self.place = PerfectHash(np.fromiter(map(self.hash, tokens), np.uint64, len(tokens)))
        at = self.place(np.fromiter(map(self.hash, tokens), np.uint64, len(tokens)))
        self.keys: list[bytes] = [b""] * len(tokens)
        for token, k in zip(tokens, at, strict=True):
            self.keys[k] = token
        self.limit, self.memo, self.earlier = limit, {}, {}

    def _learn(self, pieces: set[str]) -> dict[str, bytes]:
        """The memo (ids as little-endian 32-bit bytes), with every piece of ``pieces`` in it."""
        if len(self.memo) + len(pieces) > self.limit:
            self.earlier, self.memo = self.memo, {}
        new = pieces.difference(self.memo)
        known = [p for p in new if p in self.earlier]
        self.memo.update(zip(known, map(self.earlier.__getitem__, known), strict=True))
        new = list(new.difference(known))
        raw = [p.encode("utf-8", "surrogatepass") for p in new]
        slots = self.place(np.fromiter(map(self.hash, raw), np.uint64, len(raw))).tolist()
        for p, b, k in zip(new, raw, slots, strict=True):
            if k >= 0 and self.keys[k] == b:
                self.memo[p] = self.ranks[b].to_bytes(4, "little")
            else:
                self.memo[p] = struct.pack(f"<{len(ids := merge_bytes(b, self.ranks))}I", *ids)
        return self.memo

    def encode_batch(self, texts: list[str | None]) -> list[bytes]:
        found = [self.find(t) if t else [] for t in texts]
        memo = self._learn(set().union(*found))
        return [b"".join(map(memo.__getitem__, f)) for f in found]


_ENCODERS: dict[tuple[str, str], Encoder] = {}
_BYTES: dict[str, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}


def encode(docs: DataFrame, rank_path: str, pattern: str, batch_rows: int = 200) -> DataFrame:
    """Add ``ids array<int>`` to (doc_id, text, ...)."""
    schema = T.StructType([*docs.schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType(), False))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = (rank_path, pattern)
        if key not in _ENCODERS:
            _ENCODERS[key] = Encoder(*key)
        for whole in batches:
            for lo in range(0, whole.num_rows, batch_rows):
                batch = whole.slice(lo, batch_rows)
                coded = _ENCODERS[key].encode_batch(batch.column(batch.schema.get_field_index("text")).to_pylist())
                ends = np.cumsum([0] + [len(c) // 4 for c in coded]).astype(np.int32)
                values = pa.array(np.frombuffer(b"".join(coded), dtype=np.int32))
                ids = pa.ListArray.from_arrays(pa.array(ends), values)
                yield pa.RecordBatch.from_arrays([*batch.columns, ids], names=[*batch.schema.names, "ids"])

    return docs.mapInArrow(run, schema)


def decode(encoded: DataFrame, rank_path: str) -> DataFrame:
    """Add ``decoded binary``, the concatenated bytes of ``ids``; NULL ids decode to no bytes."""
    schema = T.StructType([*encoded.schema.fields, T.StructField("decoded", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if rank_path not in _BYTES:
            by_rank = {r: b for b, r in read_ranks(rank_path).items()}
            length = np.zeros(max(by_rank) + 1, dtype=np.int64)
            for r, b in by_rank.items():
                length[r] = len(b)
            first = np.concatenate(([0], np.cumsum(length)[:-1]))
            flat = np.frombuffer(b"".join(by_rank.get(r, b"") for r in range(len(length))), dtype=np.uint8)
            _BYTES[rank_path] = (flat, first, length)
        flat, first, length = _BYTES[rank_path]
        for batch in batches:
            column = batch.column(batch.schema.get_field_index("ids"))
            out = []
            for ids in column:
                at = ids.values.to_numpy() if ids.is_valid else np.zeros(0, dtype=np.int64)
                size = length[at]
                shift = np.repeat(first[at] - (np.cumsum(size) - size), size)
                out.append(flat[shift + np.arange(len(shift))].tobytes())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], names=[*batch.schema.names, "decoded"])

    return encoded.mapInArrow(run, schema)


def round_trip(docs: DataFrame, rank_path: str, pattern: str) -> DataFrame:
    """doc_id, ids, decoded: every text encoded and decoded again."""
    return decode(encode(docs.select("doc_id", "text"), rank_path, pattern).drop("text"), rank_path)


def digests(coded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of ``round_trip`` rows."""
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
