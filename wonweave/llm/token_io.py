"""Operator 1: token ids as canonical, length-limited Huffman codes in independent blocks.

File format: a folder of two Parquet tables. `lengths` has the code length of each id that occurs;
the canonical codes follow from it: shorter codes first, then smaller ids. `blocks` has one row
per block: `part` and `block` order the blocks; `payload` holds the codes of the block's ids,
most significant bit first; `checkpoints` the bit offset of every CHECKPOINT-th id; `doc_ids`
and `doc_tokens` its documents, whole, in order. A reader needs nothing but the folder.

More ids than codes of `limit` bits are an error. A document of any length is whole in one
block, so the longest document bounds a task's memory from below.
Nulls: a null text is empty, a null doc_id sorts first. Documents with equal ids are ordered
by the checksum of their ids. Empty tables give empty results. Extra columns are ignored.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wonweave.llm import common

CHECKPOINT = 128
BLOCK_TOKENS = 1 << 18
#: Matches whose ids are kept.
MOST_MATCHES = 100_000
_TOKENIZERS: dict[str, common.ChunkCache] = {}


#: Letters, digits and punctuation that all versions of the pattern's classes agree on; single line feeds. No apostrophes: these may begin a match of their own.
_LETTERS, _MARKS = "A-Za-zª\u00b5ºÀ-ÖØ-öø-ÿ", re.escape("!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~")
_OTHER = re.compile(rf"[^ {_LETTERS}]")
_PLAIN = re.compile(rf" ?[{_LETTERS}]+| ?[0-9]+| ?[{_MARKS}]+|\n")
_ALL_PLAIN = re.compile(rf" ?(?:[{_LETTERS}0-9{_MARKS}]+(?:\n[{_LETTERS}0-9{_MARKS}]+)*)|\n")


def byte_letters() -> dict[int, str]:
    """The letter that a byte-level vocabulary writes for each byte: printable ones stand for themselves, the others follow 255 in order."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = (b for b in range(256) if b not in shown)
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(others)}


def _cache(vocabulary: str) -> common.ChunkCache:
    """The worker's cache over the tokenizers library."""
    if vocabulary not in _TOKENIZERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(vocabulary)

        letters, tokenize = byte_letters(), tokenizer.model.tokenize
        added = re.compile("|".join(re.escape(t.content) for t in tokenizer.get_added_tokens_decoder().values()) or r"(?!)")
        known: dict[str, bytes] = {}

        def ids_of(matches: list[str]) -> list[bytes]:
            """The ids of matches of the pattern, each by the library's model."""
            named = "\0".join(matches).encode().decode("latin-1").translate(letters).split(letters[0]) if matches else []
            return [array("I", [t.id for t in tokenize(x)]).tobytes() for x in named]

        def encode(prefix: str, words: list[str]) -> list[bytes]:
            """Chunks that plainly are one match or a few are given to the library's model match by match, the others to the whole tokenizer."""
            out: list[bytes | None] = [None] * len(words)
            one = [i for i, w in enumerate(words) if w.isalpha() and not _OTHER.search(w)]
            for i, ids in zip(one, ids_of([prefix + words[i] for i in one]), strict=True):
                out[i] = ids
            rest = [i for i, x in enumerate(out) if x is None]
            several = {i: _PLAIN.findall(prefix + words[i]) for i in rest if _ALL_PLAIN.fullmatch(prefix + words[i]) and not added.search(words[i])}
            if len(known) > MOST_MATCHES:
                known.clear()
            new = list({m for x in several.values() for m in x} - known.keys())
            known.update(zip(new, ids_of(new), strict=True))
            for i, matches in several.items():
                out[i] = b"".join(map(known.__getitem__, matches))
            whole = [i for i in rest if out[i] is None]
            for i, e in zip(whole, tokenizer.encode_batch_fast([prefix + words[i] for i in whole], add_special_tokens=False), strict=True):
                out[i] = np.array(e.ids, "<u4").tobytes()
            return out

        _TOKENIZERS[vocabulary] = common.ChunkCache(encode, whole=added)
    return _TOKENIZERS[vocabulary]


def tokenize(docs: DataFrame, vocabulary: str, end_id: int) -> DataFrame:
    """doc_id, crc, ids (little-endian unsigned 32-bit, with the end id)."""
    schema = pa.schema([("doc_id", pa.int64()), ("crc", pa.int64()), ("n", pa.int64()), ("ids", pa.binary())])
    end = np.array([end_id], "<u4").tobytes()

    def work(columns: list[list]) -> list:
        ids = [x + end for x in _cache(vocabulary).texts(columns[1])]
        small = [np.frombuffer(x, "<u4") for x in ids]
        return [columns[0], [zlib.crc32(x) for x in ids], [len(x) for x in small], [x.astype("<u2").tobytes() if len(x) and x.max() < 65536 else b"\0" + x.tobytes() for x in small]]

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(common.by_slice(schema, work), "doc_id long, crc long, n long, ids binary")


def _ids(data: bytes) -> np.ndarray:
    """Two bytes an id where all fit, else a zero byte and four bytes an id; an odd length tells them apart."""
    return np.frombuffer(data, "<u4", offset=1) if len(data) % 2 else np.frombuffer(data, "<u2").astype(np.uint32)


def count_ids(tokens: DataFrame) -> DataFrame:
    """id, n over all documents; each task sends a count for each id that it saw."""
    schema = pa.schema([("id", pa.int64()), ("n", pa.int64())])

    @common.lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            if batch.num_rows:
                n = np.bincount(np.concatenate([_ids(data) for data in batch.column(0).to_pylist()]), minlength=len(total))
                n[: len(total)] += total
                total = n
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], schema=schema)

    return tokens.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def code_lengths(counts: np.ndarray, limit: int) -> np.ndarray:
    """Optimal code lengths of at most `limit` bits by package-merge; counts must be positive."""
    n = len(counts)
    if n <= 1:
        return np.ones(n, np.int64)
    if n > 1 << limit:
        raise ValueError(f"{n} ids can't have codes of {limit} bits")
    order = np.argsort(counts, kind="stable")
    leaves = counts[order].astype(np.int64)
    level, is_leaf = leaves, [np.ones(n, bool)]
    for _ in range(limit - 1):
        pairs = level[: len(level) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([leaves, pairs])
        by = np.argsort(both, kind="stable")
        level = both[by]
        is_leaf.append(by < n)
    lengths, take = np.zeros(n, np.int64), 2 * n - 2
    for flags in reversed(is_leaf):
        k = int(flags[:take].sum())
        lengths[:k] += 1
        take = 2 * (take - k)
    out = np.zeros(n, np.int64)
    out[order] = lengths
    return out


@dataclass
class Code:
    """Canonical: shorter codes first, then smaller ids."""

    ids: np.ndarray
    lengths: np.ndarray

    @classmethod
    def of(cls, counts: dict[int, int], limit: int = 16) -> Code:
        ids = np.array(sorted(counts), np.int64)
        n = np.array([counts[i] for i in ids.tolist()], np.int64)
        return cls(ids, code_lengths(n, limit))

    @property
    def most(self) -> int:
        return int(self.lengths.max(initial=1))

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """By id: code, length; by the next `most` bits: id, length."""
        order = np.lexsort((self.ids, self.lengths))
        lengths = self.lengths[order]
        # the code of each, as a fraction of 2**most, is the sum of what comes before it
        left = np.concatenate([[0], np.cumsum(1 << (self.most - lengths))])
        size = int(self.ids.max(initial=0)) + 1
        code, bits = np.zeros(size, np.uint64), np.zeros(size, np.uint64)
        code[self.ids[order]] = left[:-1] >> (self.most - lengths)
        bits[self.ids[order]] = lengths
        runs = np.diff(left)
        to_id, to_bits = np.zeros(1 << self.most, np.uint32), np.ones(1 << self.most, np.int64)
        to_id[: left[-1]] = np.repeat(self.ids[order], runs)
        to_bits[: left[-1]] = np.repeat(lengths, runs)
        return code, bits, to_id, to_bits


def pack(ids: np.ndarray, code: np.ndarray, bits: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The codes of ids one after the other, and the bit offset of every CHECKPOINT-th."""
    if not len(ids):
        return b"", np.zeros(0, np.int64)
    n = bits[ids]
    ends = np.cumsum(n)
    at = ends - n
    word = (at >> np.uint64(5)).astype(np.int64)
    value = code[ids] << (np.uint64(64) - n - (at & np.uint64(31)))
    first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
    value, word = np.bitwise_or.reduceat(value, first), word[first]
    out = np.zeros(int(word[-1]) + 2, np.uint64)
    out[word] = value >> np.uint64(32)
    out[word + 1] |= value & np.uint64(0xFFFFFFFF)
    return out.astype(">u4").tobytes()[: (int(ends[-1]) + 7) // 8], at[::CHECKPOINT].astype(np.int64)


def unpack(payload: bytes, checkpoints: np.ndarray, n: int, to_id: np.ndarray, to_bits: np.ndarray) -> np.ndarray:
    """n ids. All stretches between checkpoints are decoded side by side, an id of each at a time."""
    if not n:
        return np.zeros(0, np.uint32)
    most = len(to_id).bit_length() - 1
    data = np.frombuffer(payload + bytes(8), np.uint8).astype(np.uint64)
    window = (data[:-4] << np.uint64(32)) | (data[1:-3] << np.uint64(24)) | (data[2:-2] << np.uint64(16)) | (data[3:-1] << np.uint64(8)) | data[4:]  # 40 bits from each byte on
    at = checkpoints.copy()
    out = np.zeros((CHECKPOINT, len(at)), np.uint32)
    mask = np.uint64((1 << most) - 1)
    full = n - (len(at) - 1) * CHECKPOINT  # ids in the last stretch
    for i in range(min(CHECKPOINT, n)):
        live = len(at) if i < full else len(at) - 1
        here = at[:live]
        key = (window[here >> 3] >> (40 - most - (here & 7)).astype(np.uint64)) & mask
        out[i, :live] = to_id[key]
        at[:live] += to_bits[key]
    return out.T.reshape(-1)[:n]


LENGTHS = T.StructType([T.StructField("id", T.LongType()), T.StructField("length", T.LongType())])
BLOCKS = T.StructType([T.StructField("part", T.LongType()), T.StructField("block", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("payload", T.BinaryType()), T.StructField("checkpoints", T.ArrayType(T.LongType())), T.StructField("doc_ids", T.ArrayType(T.LongType())), T.StructField("doc_tokens", T.ArrayType(T.LongType()))])


def encode_blocks(tokens: DataFrame, code: Code) -> DataFrame:
    """Blocks of `tokens`, in ascending order of doc_id."""
    schema = pa.schema([("part", pa.int64()), ("block", pa.int64()), ("n_tokens", pa.int64()), ("payload", pa.binary()), ("checkpoints", pa.list_(pa.int64())), ("doc_ids", pa.list_(pa.int64())), ("doc_tokens", pa.list_(pa.int64()))])
    shared = tokens.sparkSession.sparkContext.broadcast((code.ids, code.lengths))  # an entry per id of the vocabulary

    @common.lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_id, bits, *_ = Code(*shared.value).tables()
        part, block, held, docs, sizes = TaskContext.get().partitionId(), 0, [], [], []

        def flush() -> pa.RecordBatch:
            ids = np.concatenate(held)
            payload, checkpoints = pack(ids, by_id, bits)
            return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip((part, block, len(ids), payload, checkpoints.tolist(), docs, sizes), schema, strict=True)], schema=schema)

        total = 0
        for batch in batches:
            for doc, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids = _ids(data)
                held.append(ids)
                docs.append(doc)
                sizes.append(len(ids))
                total += len(ids)
                if total >= BLOCK_TOKENS:
                    yield flush()
                    block, held, docs, sizes, total = block + 1, [], [], [], 0
        if held:
            yield flush()

    ordered = tokens.select("doc_id", "crc", "ids").repartitionByRange("doc_id", "crc").sortWithinPartitions("doc_id", "crc")
    return ordered.select("doc_id", "ids").mapInArrow(run, BLOCKS)


def decode_blocks(blocks: DataFrame, code: Code) -> DataFrame:
    """part, block, nth (of the document in its block), doc_id, offset (ids before it in the block), ids."""
    schema = pa.schema([("part", pa.int64()), ("block", pa.int64()), ("nth", pa.int64()), ("doc_id", pa.int64()), ("offset", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])
    shared = blocks.sparkSession.sparkContext.broadcast((code.ids, code.lengths))

    @common.lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        *_, to_id, to_bits = Code(*shared.value).tables()
        for batch in batches:
            for i in range(batch.num_rows):
                part, block, n, payload, checkpoints, docs, sizes = (c[i].as_py() for c in batch.columns)
                ids = unpack(payload, np.array(checkpoints, np.int64), n, to_id, to_bits).astype("<u4")
                ends = np.cumsum(sizes)
                starts = ends - sizes
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(([part] * len(docs), [block] * len(docs), list(range(len(docs))), docs, starts, sizes, [ids[a:b].tobytes() for a, b in zip(starts, ends, strict=True)]), schema, strict=True)], schema=schema)

    return blocks.mapInArrow(run, "part long, block long, nth long, doc_id long, offset long, n_tokens long, ids binary")


def block_starts(blocks: DataFrame) -> DataFrame:
    """part, block, start: ids in all blocks before. Only a total for each partition comes to the driver."""
    spark = blocks.sparkSession
    totals = sorted((r.part, r.n) for r in blocks.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect())
    sums = np.concatenate([[0], np.cumsum([n for _, n in totals])]).astype(int)
    before = spark.createDataFrame([(p, int(s)) for (p, _), s in zip(totals, sums[:-1], strict=True)], "part long, before long")
    inside = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("block")) - F.col("n_tokens")
    return blocks.select("part", "block", "n_tokens").withColumn("inside", inside).join(F.broadcast(before), "part").select("part", "block", (F.col("inside") + F.col("before")).alias("start"))


def write_tokens(docs: DataFrame, vocabulary: str, end_id: int = 2, limit: int = 16, path: str | None = None) -> str:
    """Encodes all texts and writes the files, to a new shared folder unless `path` is given; returns the folder."""
    spark = docs.sparkSession
    path = path or common.scratch(spark, "token-files")
    tokens = common.staged(tokenize(docs, vocabulary, end_id), "tokens")
    code = Code.of({r.id: r.n for r in count_ids(tokens).collect()}, limit)  # an entry per id of the vocabulary
    spark.createDataFrame(list(zip(code.ids.tolist(), code.lengths.tolist(), strict=True)), LENGTHS).coalesce(1).write.parquet(f"{path}/lengths")
    with common.staging(spark):
        encode_blocks(tokens, code).write.option("compression", "uncompressed").parquet(f"{path}/blocks")
    common.drop(tokens)
    return path


def read_blocks(spark: SparkSession, path: str) -> tuple[DataFrame, Code]:
    """The blocks and the code of a folder of token files; nothing else is needed to decode them."""
    rows = sorted((r.id, r.length) for r in spark.read.schema(LENGTHS).parquet(f"{path}/lengths").collect())
    ids, lengths = (np.array([r[i] for r in rows], np.int64) for i in (0, 1))
    return spark.read.schema(BLOCKS).parquet(f"{path}/blocks"), Code(ids, lengths)


def _placed(decoded: DataFrame, blocks: DataFrame) -> DataFrame:
    return decoded.join(block_starts(blocks), ["part", "block"]).withColumn("start", F.col("start") + F.col("offset"))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids of each document in the files."""
    blocks, code = read_blocks(spark, path)
    return _placed(decode_blocks(blocks, code), blocks).select("doc_id", "start", "n_tokens", "ids")


def digests(spark: SparkSession, path: str) -> DataFrame:
    """As read_tokens(), with the checksum of the ids in their place; they aren't moved."""
    blocks, code = read_blocks(spark, path)
    summed = decode_blocks(blocks, code).select("part", "block", "doc_id", "offset", "n_tokens", F.crc32("ids").alias("ids_crc32"))
    return _placed(summed, blocks).select("doc_id", "start", "n_tokens", "ids_crc32")
