"""Operator 8: byte-level BPE encoding and decoding with length-bucketed numpy matrices.

Distinct matches of the pattern are put into matrices of rows of about equal length, padded.
In each round every row merges its leftmost pair of the least rank, found by a hashed lookup
of (left id, right id); rows without a pair left leave the matrix. A row of over BLOCK ids is a
matrix of its own blocks.

A null text is empty and has no ids. Lone surrogates can't occur in a Spark string. Repeated
rows give repeated results, empty tables empty ones, extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from functools import cached_property

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wonweave.llm import common

NO_RANK = np.int32(2**31 - 1)
#: A row of more ids than this has the leasts of so many ranks each, and isn't moved as it shrinks; its rounds are the same.
BLOCK = 512


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class PairTable:
    """(left id, right id) to the id of both together: open addressing in two arrays."""

    def __init__(self, ranks: dict[bytes, int]):
        left, right, joined = [], [], []
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                a, b = ranks.get(token[:i]), ranks.get(token[i:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    joined.append(rank)
        keys = self._key(np.array(left, np.int64), np.array(right, np.int64))
        values = np.array(joined, np.int32)
        self.bits = max(4, int(len(keys) * 4).bit_length())
        self.keys, self.values = np.zeros(1 << self.bits, np.uint64), np.full(1 << self.bits, NO_RANK, np.int32)
        at = self._slot(keys)
        self.most = 0
        while len(keys):
            self.most += 1
            free = self.keys[at] == 0
            self.keys[at[free]] = keys[free]  # of several for a slot the last stays
            put = self.keys[at] == keys
            self.values[at[put]] = values[put]
            keys, values, at = keys[~put], values[~put], (at[~put] + 1) & ((1 << self.bits) - 1)

    @cached_property
    def _by_key(self) -> dict[int, int]:
        used = self.keys != 0
        return dict(zip(self.keys[used].tolist(), self.values[used].tolist(), strict=True))

    def one(self, left: int, right: int) -> int:
        """The rank of one pair."""
        return self._by_key.get((left << 32) + right + 1, int(NO_RANK))

    @staticmethod
    def _key(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return (left.astype(np.uint64) << np.uint64(32)) + right.astype(np.uint64) + np.uint64(1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        x = keys * np.uint64(0x9E3779B97F4A7C15)
        return ((x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, NO_RANK if none; negative ids pair with nothing."""
        out = np.full(left.shape, NO_RANK, np.int32)
        todo = np.flatnonzero((left.ravel() >= 0) & (right.ravel() >= 0))
        keys = self._key(left.ravel()[todo], right.ravel()[todo])
        at, flat = self._slot(keys), out.ravel()
        for _ in range(self.most):
            found = self.keys[at]
            hit = found == keys
            flat[todo[hit]] = self.values[at[hit]]
            on = ~hit & (found != 0)
            if not on.any():
                break
            todo, keys, at = todo[on], keys[on], (at[on] + 1) & ((1 << self.bits) - 1)
        return out


class Bpe:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.pattern = regex.compile(pattern)
        self.ranks, self.pairs = ranks, PairTable(ranks)
        self.byte_id = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        size = max(ranks.values()) + 1
        tokens = [b""] * size
        for token, rank in ranks.items():
            tokens[rank] = token
        self.tokens = tokens
        self.cache = common.ChunkCache(self._chunks)

    def merge(self, words: list[bytes]) -> list[np.ndarray]:
        """The ids of each word by itself."""
        out: list[np.ndarray] = [np.zeros(0, np.int32)] * len(words)
        sizes = np.array([len(w) for w in words], np.int64)
        # buckets: every length up to 16, then steps of about a quarter
        width = np.where(sizes <= 16, sizes, np.ceil(1.25 ** np.ceil(np.log(np.maximum(sizes, 1)) / np.log(1.25))).astype(np.int64))
        by = np.argsort(width, kind="stable")
        for rows in np.split(by, np.flatnonzero(np.diff(width[by])) + 1):
            if not len(rows) or sizes[rows[0]] == 0:
                rows = rows[sizes[rows] > 0] if len(rows) else rows
            most = int(sizes[rows].max(initial=0))
            step = max(1, 2_000_000 // max(most, 1))
            for i in range(0, len(rows), step):
                self._bucket(words, rows[i : i + step], out)
        return out

    def _bucket(self, words: list[bytes], rows: np.ndarray, out: list[np.ndarray]) -> None:
        if not len(rows):
            return
        sizes = np.array([len(words[r]) for r in rows])
        ids = np.full((len(rows), int(sizes.max())), -1, np.int32)
        ids[np.arange(ids.shape[1]) < sizes[:, None]] = self.byte_id[np.frombuffer(b"".join(words[r] for r in rows), np.uint8)]
        if ids.shape[1] > BLOCK:
            for r, row, n in zip(rows, ids, sizes, strict=True):
                out[r] = self._wide(row[:n])
            return
        ranks = self.pairs(ids[:, :-1], ids[:, 1:])
        while True:
            if ranks.shape[1]:
                at = ranks.argmin(axis=1)
                best = ranks[np.arange(len(rows)), at]
            else:
                best = np.full(len(rows), NO_RANK, np.int32)
            done = best == NO_RANK
            if done.any():
                lengths = (ids[done] >= 0).sum(axis=1)
                for r, row, n in zip(rows[done], ids[done], lengths, strict=True):
                    out[r] = row[:n]
                keep = ~done
                if not keep.any():
                    return
                rows, ids, ranks, at, best = rows[keep], ids[keep], ranks[keep], at[keep], best[keep]
                used = int((ids >= 0).sum(axis=1).max())
                ids, ranks = ids[:, :used], ranks[:, : used - 1]
            line, columns = np.arange(len(rows)), np.arange(ids.shape[1] - 1)
            ids[line, at] = best
            ids = np.where(columns <= at[:, None], ids[:, :-1], ids[:, 1:])
            ranks = np.where(columns[:-1] <= at[:, None], ranks[:, :-1], ranks[:, 1:])
            if not ranks.shape[1]:
                continue
            # only the pairs on both sides of what was merged are new
            for where, ok in ((at - 1, at > 0), (at, at < ids.shape[1] - 1)):
                r, c = line[ok], where[ok]
                ranks[r, c] = self.pairs(ids[r, c], ids[r, c + 1])

    def _wide(self, ids: np.ndarray) -> np.ndarray:
        """The same rounds for a row of many ids: the leftmost pair of the least rank merges, found by the least of each BLOCK ranks, and what is merged is unlinked in place of moving the rest."""
        n, one = len(ids), self.pairs.one
        ranks = np.full(-(-n // BLOCK) * BLOCK, NO_RANK, np.int32)
        ranks[: n - 1] = self.pairs(ids[:-1], ids[1:])
        blocks = ranks.reshape(-1, BLOCK)
        least = blocks.min(axis=1)
        at_id, after, before = ids.tolist(), list(range(1, n + 1)), list(range(-1, n - 1))
        while (best := int(least[b := int(least.argmin())])) != NO_RANK:
            left = b * BLOCK + int(blocks[b].argmin())
            gone = after[left]
            at_id[left], after[left], ranks[gone] = best, after[gone], NO_RANK
            if after[left] < n:
                before[after[left]] = left
                ranks[left] = one(best, at_id[after[left]])
            else:
                ranks[left] = NO_RANK
            touched = {left // BLOCK, gone // BLOCK}
            if before[left] >= 0:
                ranks[before[left]] = one(at_id[before[left]], best)
                touched.add(before[left] // BLOCK)
            for x in touched:
                least[x] = blocks[x].min()
        out, at = [], 0
        while at < n:
            out.append(at_id[at])
            at = after[at]
        return np.array(out, np.int32)

    def _chunks(self, prefix: str, chunks: list[str]) -> list[bytes]:
        parts = [self.pattern.findall(prefix + c) for c in chunks]
        words = list({w for p in parts for w in p})
        known = {w: ids.astype("<u4").tobytes() for w, ids in zip(words, self.merge([w.encode() for w in words]), strict=True)}
        return [b"".join(map(known.__getitem__, p)) for p in parts]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        return self.cache.texts(texts)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_MODELS: dict[tuple[str, str], Bpe] = {}


def model(ranks: str, pattern: str) -> Bpe:
    """The worker's model for a rank file and a pattern."""
    if (ranks, pattern) not in _MODELS:
        _MODELS[ranks, pattern] = Bpe(read_ranks(ranks), pattern)
    return _MODELS[ranks, pattern]


def encode(docs: DataFrame, ranks: str, pattern: str, kept: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns `kept`, n_tokens, ids (little-endian unsigned 32-bit) and decoded_sha256, the digest of the bytes of those ids."""
    return _run(docs, ranks, pattern, kept, lambda ids, decoded: (ids, hashlib.sha256(decoded).hexdigest()), [("ids", pa.binary()), ("decoded_sha256", pa.string())], "ids binary, decoded_sha256 string")


def digests(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """As encode(), with the digest of the ids in their place."""
    return _run(docs, ranks, pattern, ("doc_id",), lambda ids, decoded: (hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded).hexdigest()), [("ids_sha256", pa.string()), ("decoded_sha256", pa.string())], "ids_sha256 string, decoded_sha256 string")


def _run(docs: DataFrame, ranks: str, pattern: str, kept: tuple[str, ...], made, fields: list, ddl: str) -> DataFrame:
    docs = docs.select(*[F.col(c) for c in kept], "text")
    types = [docs.schema[c] for c in kept]
    from pyspark.sql.pandas.types import to_arrow_type

    schema = pa.schema([*[(f.name, to_arrow_type(f.dataType)) for f in types], ("n_tokens", pa.int64()), *fields])

    def work(columns: list[list]) -> list:
        bpe = model(ranks, pattern)
        ids = bpe.encode(columns[-1])
        out = [made(x, bpe.decode(x)) for x in ids]
        return [*columns[:-1], [len(x) // 4 for x in ids], *([x[i] for x in out] for i in range(len(fields)))]

    return docs.mapInArrow(common.by_slice(schema, work), ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in types), "n_tokens long", ddl]))
