"""What the operators share: tables, shared scratch folders, Arrow batches, token chunks."""

from __future__ import annotations

import ctypes
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager, suppress
from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text processed at once by a Python worker; a longer document is processed alone.
SLICE_BYTES = 4_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lowered(c: Column) -> Column:
    """With A-Z as a-z, and all else as it is."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host(url: Column) -> Column:
    """What is between the first :// and the path; empty if there is none."""
    return lowered(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def draw(c: Column, seed: int) -> Column:
    """A number from 0 to 1 by hash, in steps of 2**-53."""
    return F.shiftrightunsigned(F.xxhash64(c, F.lit(seed)), 11) / float(1 << 53)


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share (spark.checkpoint.dir).

    Where that is unset a folder of this machine is set, but only with a local master: on a
    cluster executors would write to folders of their own, so it is an error there.
    """
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        context = spark.sparkContext
        if context._jsc.sc().getCheckpointDir().isEmpty():
            if not re.fullmatch(r"local(\[.*\])?", context.master):
                raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
            context.setCheckpointDir(tempfile.mkdtemp(prefix="wonweave-"))
        top = context._jsc.sc().getCheckpointDir().get()
    return f"{top.rstrip('/')}/{name}-{uuid.uuid4().hex}"


#: While a table is staged: Arrow batches are limited by bytes, and shuffle files go as soon as what they were for is written.
STAGING = {"spark.sql.execution.arrow.maxBytesPerBatch": str(SLICE_BYTES), "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def bounded(spark: SparkSession) -> None:
    """Limits the session's Arrow batches by bytes, for frames that an operator returns before they run."""
    key, most = "spark.sql.execution.arrow.maxBytesPerBatch", int(STAGING["spark.sql.execution.arrow.maxBytesPerBatch"])
    now = int(re.match(r"-?\d+", spark.conf.get(key))[0])
    if not 0 < now <= most:
        spark.conf.set(key, str(most))


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    before = {k: spark.conf.get(k, None) for k in STAGING}
    for k, v in STAGING.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def staged(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """df, written as Parquet to shared storage and read back: cuts the lineage, so that a lost executor costs only what it was running."""
    spark, path = df.sparkSession, scratch(df.sparkSession, name)
    schema = df.schema
    with staging(spark):
        df.write.option("compression", codec).parquet(path)
    out = spark.read.schema(schema).parquet(path)
    out._staged_at = path
    return out


def drop(*tables: DataFrame) -> None:
    """Removes the files of staged() tables that nothing reads any more."""
    for df in tables:
        spark, place = df.sparkSession, df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._staged_at)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a binary or string array without nulls; nothing is copied."""
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), at


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of up to `limit` bytes in all; a longer text is alone."""
    i = 0
    while i < len(offsets) - 1:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1)
        yield i, j
        i = j


def lean(run: Callable) -> Callable:
    """`run`, a function for mapInArrow, that gives freed memory back to the machine when its task ends: Spark keeps its Python workers."""

    @wraps(run)
    def tidy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            with suppress(OSError, AttributeError):  # another C library
                ctypes.CDLL("libc.so.6").malloc_trim(0)

    return tidy


def by_slice(schema: pa.Schema, work: Callable[[list[list]], list], limit: int = SLICE_BYTES) -> Callable:
    """A function for mapInArrow. `work` gets the columns of a slice as lists, the text last, and returns the columns of `schema`."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            lengths = pa.compute.binary_length(texts).fill_null(0).to_pylist()
            begin = size = 0
            ranges = []
            for i, n in enumerate(lengths):
                if i > begin and size + n > limit:
                    ranges.append((begin, i))
                    begin, size = i, 0
                size += n
            if begin < len(lengths):
                ranges.append((begin, len(lengths)))
            for lo, hi in ranges:
                part = batch.slice(lo, hi - lo)
                out = work([c.to_pylist() for c in part.columns])
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema, strict=True)], schema=schema)

    return run


_BOUNDARY = re.compile(r"(?<=\S)(?= \S)")
_U = np.uint64
#: Bytes of texts whose words are looked up together.
WORDS_AT_ONCE = 1 << 20


#: ASCII letters, and punctuation but for the apostrophe, which may begin a match of its own.
_LETTER, _MARK = np.zeros(256, bool), np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_MARK[[c for c in range(33, 127) if not chr(c).isalnum() and chr(c) != "'"]] = True


class _WordHash:
    """A 64-bit hash of any stretches of bytes: differences of running sums of random numbers for bytes times powers of an odd base.

    It only brings together what may be the same; such hashes agree on some words that differ.
    """

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.numbers = rng.integers(0, 2**64, 256, dtype=np.uint64)
        self.base = int(rng.integers(2**62, 2**63)) | 1
        self.powers = self.inverse = np.ones(1, np.uint64)

    def _grown(self, x: np.ndarray, base: int, n: int) -> np.ndarray:
        while len(x) < n:
            x = np.concatenate([x, x * _U(pow(base, len(x), 2**64))])
        return x

    def __call__(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        self.powers = self._grown(self.powers, self.base, len(data) + 1)
        self.inverse = self._grown(self.inverse, pow(self.base, -1, 2**64), len(data) + 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.numbers[data] * self.powers[: len(data)], out=sums[1:])
        h = (sums[end] - sums[begin]) * self.inverse[begin] + (end - begin).astype(np.uint64)
        h ^= h >> _U(32)
        return h * _U(0x9E3779B97F4A7C15)


def same_bytes(a: np.ndarray, a_begin: np.ndarray, b: np.ndarray, b_begin: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Which of the stretches of n bytes, from a_begin in a and from b_begin in b, are the same."""
    ends = np.cumsum(n)
    inside = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - n, n)
    differ = np.concatenate([[0], np.cumsum(a[np.repeat(a_begin, n) + inside] != b[np.repeat(b_begin, n) + inside])])
    return differ[ends] == differ[ends - n]


class ChunkCache:
    """Token ids of space-separated chunks, kept between texts.

    A byte-level BPE vocabulary with the usual pattern always begins a new match at a space
    that stands between two characters that aren't white space, and what it finds up to the
    next such space depends on that chunk alone. So a text is cut there, distinct chunks that
    aren't known yet are encoded together, and texts are joined from the results. Beside other
    white space, and where it holds one of `whole`, a text is cut only where that holds.

    A hash brings words of a batch and of the cache together, and their bytes are compared; if
    two words of a batch have one hash, the batch is encoded without the cache, and a kept word of
    the same hash gives way. At most `most` words of up to `longest` bytes are kept,
    those used last; that bounds memory and doesn't affect results.
    """

    _hash = _WordHash(20240711)

    #: encode(prefix, chunks) returns the ids (little-endian unsigned 32-bit) of `prefix` and each chunk.
    def __init__(self, encode: Callable[[str, list[str]], list[bytes]], most: int = 600_000, longest: int = 64, whole: re.Pattern | None = None):
        self.encode, self.most, self.longest, self.whole, self.batch = encode, most, longest, whole, 0
        none = np.zeros(0, np.int64)
        #: Of kept words, in order of their hashes: where their ids and bytes are, and when they were last used.
        self.key, self.spaced, self.at, self.n, self.begin, self.size, self.used = none.view(np.uint64), none.astype(bool), none, none, none, none, none
        self.ids, self.bytes = np.zeros(0, np.uint32), np.zeros(0, np.uint8)

    def _encoded(self, data: bytes, begin: np.ndarray, end: np.ndarray, spaced: np.ndarray) -> list[bytes]:
        out: list[bytes] = [b""] * len(begin)
        for prefix, mine in (("", ~spaced), (" ", spaced)):
            where = np.flatnonzero(mine)
            if len(where):
                words = [data[b:e].decode() for b, e in zip(begin[where].tolist(), end[where].tolist(), strict=True)]
                for i, ids in zip(where.tolist(), self.encode(prefix, words), strict=True):
                    out[i] = ids
        return out

    def _keep(self, words: list[np.ndarray]) -> None:
        """Keeps these words; if they are too many, those used last. What other words had goes, once it is most of what is held."""
        if len(words[0]) > self.most:
            last = np.sort(np.argsort(words[-1], kind="stable")[-(self.most * 3 // 4) :])
            words = [x[last] for x in words]
        self.key, self.spaced, self.at, self.n, self.begin, self.size, self.used = words
        if len(self.ids) > 8 * self.most or len(self.bytes) > 32 * self.most:
            ends, stops = np.cumsum(self.n), np.cumsum(self.size)
            self.ids = self.ids[np.repeat(self.at - ends + self.n, self.n) + np.arange(self.n.sum())]
            self.bytes = self.bytes[np.repeat(self.begin - stops + self.size, self.size) + np.arange(self.size.sum())]
            self.at, self.begin = ends - self.n, stops - self.size

    def _words(self, data: bytes, begin: np.ndarray, end: np.ndarray, spaced: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(how many ids each word has, all ids)."""
        array = np.frombuffer(data, np.uint8)
        key, first, place = np.unique(self._hash(array, begin, end) ^ spaced.astype(np.uint64), return_index=True, return_inverse=True)
        size = end - begin
        again = np.flatnonzero(first[place] != np.arange(len(place)))
        of = first[place[again]]
        alike = (size[again] == size[of]) & (spaced[again] == spaced[of])
        if not (alike.all() and same_bytes(array, begin[again], array, begin[of], size[again]).all()):
            found = self._encoded(data, begin, end, spaced)
            return np.array([len(x) // 4 for x in found], np.int64), np.frombuffer(b"".join(found), "<u4")
        self.batch += 1
        known = np.zeros(len(key), bool)
        where = np.searchsorted(self.key, key)
        where[where == len(self.key)] = 0
        if len(self.key):
            maybe = np.flatnonzero((self.key[where] == key) & (self.size[where] == size[first]) & (self.spaced[where] == spaced[first]))
            known[maybe] = same_bytes(array, begin[first[maybe]], self.bytes, self.begin[where[maybe]], size[first[maybe]])
        missing = np.flatnonzero(~known)
        starts, counts = np.zeros(len(key), np.int64), np.zeros(len(key), np.int64)
        starts[known], counts[known] = self.at[where[known]], self.n[where[known]]
        self.used[where[known]] = self.batch
        ids = self.ids
        if len(missing):
            at = first[missing]
            got = self._encoded(data, begin[at], end[at], spaced[at])
            n = np.array([len(x) // 4 for x in got], np.int64)
            counts[missing], starts[missing] = n, len(ids) + np.cumsum(n) - n
            ids = np.concatenate([ids, np.frombuffer(b"".join(got), "<u4")])
        each = counts[place]
        ends = np.cumsum(each)
        out = ids[np.repeat(starts[place] - ends + each, each) + np.arange(ends[-1] if len(ends) else 0)]
        if len(missing):
            new = missing[size[first[missing]] <= self.longest]
            at, length = first[new], size[first[new]]
            stops = np.cumsum(length)
            kept = ~np.isin(self.key, key[new])  # a word of the same hash gives way
            added = (key[new], spaced[at], starts[new], counts[new], len(self.bytes) + stops - length, length, np.full(len(new), self.batch))
            held = (self.key, self.spaced, self.at, self.n, self.begin, self.size, self.used)
            self.ids, self.bytes = ids, np.concatenate([self.bytes, array[np.repeat(begin[at] - stops + length, length) + np.arange(length.sum())]])
            words = [np.concatenate([old[kept], add]) for old, add in zip(held, added, strict=True)]
            by = np.argsort(words[0], kind="stable")
            self._keep([x[by] for x in words])
        return each, out

    def _plain(self, bodies: list[bytes]) -> list[bytes]:
        """Of texts that are cut at every space, none empty.

        They are also cut around a line feed alone, which is a match by itself, and between a letter
        and punctuation that goes on to white space or the text's end, which is one match.
        """
        data = b"\0".join(bodies)
        array = np.frombuffer(data + b"\0", np.uint8)
        size = np.array([len(b) for b in bodies], np.int64)
        ends = np.cumsum(size + 1) - 1
        spaces = np.flatnonzero(array == 32)
        lines = np.flatnonzero(array == 10)
        lines = lines[(lines > 0) & (array[lines - 1] > 10) & (array[lines + 1] > 10)]
        mark = _MARK[array]
        edge = np.flatnonzero(mark[1:] != mark[:-1]) + 1
        run, over = (edge[1::2], edge[2::2]) if mark[0] else (edge[::2], edge[1::2])  # a text's last mark is before a 0
        before = array[run - 1]
        letter = _LETTER[before] | (before >= 128) & (array[run - 2] == 0xC3) & (before != 0x97) & (before != 0xB7)
        after = array[over]
        cuts = run[letter & ((after == 32) | (after == 10) | (after == 0))]
        inner = np.unique(np.concatenate([cuts, lines, lines + 1]))
        begin = np.concatenate([spaces + 1, inner, ends - size])
        kind = np.repeat(np.array([0, 1, 2], np.int8), [len(spaces), len(inner), len(ends)])
        by = np.argsort(begin, kind="stable")
        begin, kind = begin[by], kind[by]
        sizes, ids = self._words(data, begin, np.sort(np.concatenate([spaces, inner, ends])), kind == 0)
        cut = np.concatenate([[0], np.cumsum(sizes)])[np.append(np.flatnonzero(kind == 2), len(sizes))]
        raw = ids.astype("<u4").tobytes()
        return [raw[4 * b : 4 * e] for b, e in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]

    def texts(self, texts: list[str | None]) -> list[bytes]:
        out: list[bytes] = [b""] * len(texts)
        held: list[int] = []
        bodies: list[bytes] = []

        def flush() -> None:
            for i, ids in zip(held, self._plain(bodies) if bodies else [], strict=True):
                out[i] = ids
            held.clear()
            bodies.clear()

        cut: list[tuple[int, list[str]]] = []
        total = 0
        for i, t in enumerate(texts):
            if not t:
                continue
            # of white space only spaces are printable
            if "  " in t or " \n" in t or "\n " in t or not t.replace("\n", "").isprintable() or self.whole and self.whole.search(t):
                cut.append((i, _BOUNDARY.split(t)))
                continue
            body = t.encode()
            if held and total + len(body) > WORDS_AT_ONCE:
                flush()
                total = 0
            held.append(i)
            bodies.append(body)
            total += len(body)
        flush()
        if cut:
            chunks = list({c for _, parts in cut for c in parts})
            known = dict(zip(chunks, self.encode("", chunks), strict=True))
            for i, parts in cut:
                out[i] = b"".join(map(known.__getitem__, parts))
        return out
