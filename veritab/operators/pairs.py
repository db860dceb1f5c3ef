"""Every row receives, for each (feature, repeat), the value of the row of its rank in another order.

The rank that receives is the row's in md5(key|seed) order, the rank that gives its in md5(key|feature|repeat|seed)
order, one order per job. Rows are never copied per job. What moves is packed: the sorted hashes (about 6 bytes each)
and the values (numbers of a dictionary, if they are few) to the job's range of hashes, where they are sorted
and written; then the sorted values alone, cut at the ranks where blocks of receivers begin. Hashes move for
about ``ROUND`` pairs at a time, so their shuffle files do not add up over the jobs. Ranges hold about ``BLOCK_VALUES`` rows of a
job, blocks receive as many values over all jobs: the pieces that are cut follow the pairs, not their square. Receivers lie in
blocks by range of their own hash, so a block's first rank is the number of rows in the blocks before it. No task holds more
than a range of one job, a block of receivers or ``ROWS`` rows with one job's hashes.

Hashes are made for many rows at once, 64 steps over arrays of the texts' words; rows of equal key length lie together, so that a
job's text is written into their words as constants. Rows lie packed by ``PACKED``, short keys first, in their table, and by
block on their way there.

Rows with a null in the key give values but receive none; rows of equal key receive each other's, as a join on the key
would have it. Values are moved bit by bit: nulls and NaN stay what they are. Givers are ordered by the first 64 bits of their md5.
"""

from __future__ import annotations

import gc
import math
from collections.abc import Iterator, Mapping, Sequence
from functools import reduce
from hashlib import md5

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from veritab.functions.scalar import col_of
from veritab.session import run_table, spread

#: Values that a block of receivers gets, rows of a range; rows whose values are dealt out together; bits that stand for a null.
BLOCK_VALUES, ROWS, NULL = 2_000_000, 200_000, 0x7FF8_6E75_6C6C_0001
#: Pairs whose hashes are shuffled at once, at least those of one job; values of a dictionary.
ROUND, CODES = 150_000_000, 256
#: Rows that lie in one of the table; rows hashed at once; bytes of a text that fit one block of md5.
PACKED, HASHED, BLOCK = 32, 16_384, 55

_SHIFTS = [(np.uint32(s), np.uint32(32 - s)) for four in ((7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21)) for s in four * 4]
_SINES = [np.uint32(int(abs(math.sin(i + 1)) * 2 ** 32)) for i in range(64)]
_WORDS = [*range(16), *[(5 * i + 1) % 16 for i in range(16)], *[(3 * i + 5) % 16 for i in range(16)], *[7 * i % 16 for i in range(16)]]
_START = [np.uint32(x) for x in (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)]


def _md5(words: np.ndarray, used: int, out: np.ndarray) -> None:
    """Four words of the md5 of each column of ``words``, the 16 of one block; those from ``used`` on are zero but the size."""
    a, b, c, d = (np.full(words.shape[1], x, dtype=np.uint32) for x in _START)
    t, u = np.empty_like(a), np.empty_like(a)
    for i, (word, sine, (up, down)) in enumerate(zip(_WORDS, _SINES, _SHIFTS, strict=True)):
        if i < 16:
            np.bitwise_xor(c, d, t)
            np.bitwise_and(t, b, t)
            np.bitwise_xor(t, d, t)
        elif i < 32:
            np.bitwise_xor(b, c, t)
            np.bitwise_and(t, d, t)
            np.bitwise_xor(t, c, t)
        elif i < 48:
            np.bitwise_xor(b, c, t)
            np.bitwise_xor(t, d, t)
        else:
            np.invert(d, t)
            np.bitwise_or(t, b, t)
            np.bitwise_xor(t, c, t)
        np.add(a, t, a)
        if word < used or word == 14:
            np.add(a, words[word], a)
        np.add(a, sine, a)
        np.left_shift(a, up, u)
        np.right_shift(a, down, a)
        np.bitwise_or(a, u, a)
        np.add(a, b, a)
        a, b, c, d = d, a, b, c
    for i, (x, y) in enumerate(zip(_START, (a, b, c, d), strict=True)):
        np.add(y, x, out[:, i])


def _joined(column: pa.ChunkedArray) -> np.ndarray:
    """Bytes of a binary column, one after the other."""
    column = pa.concat_arrays(column.chunks)
    at = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2] or b"", np.uint8)[at[0]:at[-1]]


class _Keys:
    """Keys of packed rows, to be hashed with many tails. They lie by length, but for the seams of what was packed at once."""

    def __init__(self, part: pa.Table):
        self.data, size = _joined(part.column("keys")), _joined(part.column("sizes")).view(np.uint32)
        self.at = np.r_[0, np.cumsum(size, dtype=np.int64)]
        self.words, self.used = np.zeros((16, len(size)), dtype=np.uint32), 0
        self.groups = []  # first and last row, length, what the key leaves of its last word
        begin = np.flatnonzero(np.r_[True, size[1:] != size[:-1]])
        for a, z in zip(begin.tolist(), [*begin[1:].tolist(), len(size)], strict=True):
            length, rest = int(size[a]), None
            if length <= BLOCK:
                raw = np.zeros((z - a, -(-length // 4) * 4), dtype=np.uint8)
                raw[:, :length] = self.data[self.at[a]:self.at[z]].reshape(z - a, length)
                raw = raw.view(np.uint32).T
                self.words[:len(raw), a:z] = raw
                rest = raw[length // 4:].copy()
            self.groups.append((a, z, length, rest))

    def hashed(self, tail: bytes) -> np.ndarray:
        """Row x two halves of the md5 of key and tail, as numbers of eight bytes, highest first."""
        out, long = np.empty((len(self.at) - 1, 4), dtype=np.uint32), []
        for a, z, length, rest in self.groups:
            if length + len(tail) > BLOCK:
                long.append((a, z))
                continue
            end = bytes(length % 4) + tail + b"\x80"
            self.used, whole = max(self.used, length // 4 + -(-len(end) // 4)), length // 4
            for i in range(whole, min(self.used, 14)):
                word = np.uint32(int.from_bytes(end[4 * (i - whole):4 * (i - whole) + 4], "little"))
                self.words[i, a:z] = rest[0] | word if i == whole and len(rest) else word
            self.words[14, a:z] = 8 * (length + len(tail))
        for a in range(0, len(out), HASHED):
            _md5(self.words[:, a:a + HASHED], min(self.used, 14), out[a:a + HASHED])
        for a, z in long:
            at = self.at[a:z + 1].tolist()
            out[a:z] = np.frombuffer(b"".join([md5(self.data[x:y].tobytes() + tail).digest() for x, y in zip(at[:-1], at[1:], strict=True)]), np.uint32).reshape(-1, 4)
        return out.view(">u8").astype(np.uint64)


def _bits(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """The doubles' bits."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    out = flat.fill_null(0.0).to_numpy(zero_copy_only=False).view(np.int64).copy()
    out[flat.is_null().to_numpy(zero_copy_only=False)] = NULL
    return out


def _lists(bits: np.ndarray) -> pa.Array:
    flat = np.ascontiguousarray(bits).ravel()
    offsets = np.arange(len(bits) + 1, dtype=np.int32) * bits.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.float64), mask=flat == NULL))


def _coded(x: np.ndarray) -> tuple[np.ndarray | None, np.ndarray]:
    """Dictionary and number of each value, or no dictionary and the values."""
    known = np.unique(x)
    return (known, np.searchsorted(known, x).astype(np.uint8)) if len(known) <= CODES else (None, x)


def _pack_coded(known: np.ndarray | None, x: np.ndarray) -> bytes:
    """Size of the dictionary (0: none), then the dictionary, the number of values and their numbers in as few bits as hold them,
    or the values."""
    if known is None or 8 * len(known) >= 7 * len(x):
        return b"\0\0" + np.ascontiguousarray(x if known is None else known[x]).tobytes()
    bits = max(1, (len(known) - 1).bit_length())
    eight = np.zeros((-(-len(x) // 8), 8), dtype=np.uint64)
    eight.ravel()[:len(x)] = x
    packed = eight[:, 0]
    for i in range(1, 8):
        packed |= eight[:, i] << np.uint64(bits * i)
    return len(known).to_bytes(2, "little") + known.astype(np.int64).tobytes() + len(x).to_bytes(8, "little") + packed.copy().view(np.uint8).reshape(-1, 8)[:, :bits].tobytes()


def _unpack_coded(x: bytes) -> tuple[np.ndarray | None, np.ndarray]:
    size = int.from_bytes(x[:2], "little")
    if not size:
        return None, np.frombuffer(x, np.int64, offset=2)
    known, bits, n = np.frombuffer(x, np.int64, size, 2), max(1, (size - 1).bit_length()), int.from_bytes(x[2 + 8 * size:10 + 8 * size], "little")
    eight = np.zeros((-(-n // 8), 8), dtype=np.uint8)
    eight[:, :bits] = np.frombuffer(x, np.uint8, offset=10 + 8 * size).reshape(-1, bits)
    packed = eight.view(np.uint64).ravel()
    codes = np.empty((len(packed), 8), dtype=np.uint8)
    for i in range(8):
        codes[:, i] = packed >> np.uint64(bits * i) & np.uint64((1 << bits) - 1)
    return known, codes.ravel()[:n]


def _pack(x: np.ndarray) -> bytes:
    return _pack_coded(*_coded(x))


def _unpack(x: bytes) -> np.ndarray:
    known, codes = _unpack_coded(x)
    return codes if known is None else known[codes]


def _pack_sorted(h: np.ndarray) -> bytes:
    """Bytes of a low part, number of hashes, first high part, then the high parts as ones behind as many zeros as they have
    grown, then the low parts, two bytes of all at a time."""
    if not len(h):
        return bytes(17)
    span = [int(h[-1] >> np.uint64(8 * k)) - int(h[0] >> np.uint64(8 * k)) for k in (0, 2, 4, 6)]
    low = min((k for k in range(4)), key=lambda k: 16 * k * len(h) + span[k])
    high = h >> np.uint64(16 * low)
    ones = np.zeros(len(h) + span[low], dtype=bool)
    ones[(high - high[0]).astype(np.int64) + np.arange(len(h))] = True
    return (bytes([low]) + len(h).to_bytes(8, "little") + int(high[0]).to_bytes(8, "little") + np.packbits(ones).tobytes()
            + np.ascontiguousarray(np.ascontiguousarray(h).view(np.uint16).reshape(-1, 4).T[:low]).tobytes())


def _unpack_sorted(x: bytes) -> np.ndarray:
    low, n, first = x[0], int.from_bytes(x[1:9], "little"), int.from_bytes(x[9:17], "little")
    if not n:
        return np.zeros(0, dtype=np.uint64)
    at = len(x) - 2 * low * n
    ones = np.flatnonzero(np.unpackbits(np.frombuffer(x, np.uint8)[17:at]).view(bool))
    out = (ones - np.arange(n)).astype(np.uint64) + np.uint64(first) << np.uint64(16 * low)
    parts = out.view(np.uint16).reshape(-1, 4)
    for k, part in enumerate(np.frombuffer(x[at:], np.uint16).reshape(low, n)):
        parts[:, k] = part
    return out


def _ordered(h: np.ndarray, v: np.ndarray | None = None) -> np.ndarray:
    """Places of the hashes in their order, equal ones by value. The highest bits are sorted together with the place; what is
    equal in these is put right after that."""
    if len(h) < 2:
        return np.arange(len(h))
    low, bits = h.min(), (len(h) - 1).bit_length()
    spare = np.uint64(64 - int(h.max() - low).bit_length() & 63)
    mask = np.uint64((1 << bits) - 1)
    top = h - low
    top <<= spare
    top &= ~mask
    top |= np.arange(len(h), dtype=np.uint64)
    top.sort()
    order = (top & mask).view(np.int64)
    top >>= np.uint64(bits)
    same = top[1:] == top[:-1]
    if same.any():
        where = np.flatnonzero(np.r_[False, same] | np.r_[same, False])
        some = order[where]
        order[where] = some[np.lexsort((some if v is None else v[some], h[some]))]
    return order


def _written(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def _read(x: bytes | pa.Buffer) -> pa.Table:
    return pa.ipc.open_stream(x).read_all()


def _buffered(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.Table]:
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += len(batch)
        if n >= most:
            yield pa.Table.from_batches(held)
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held)


def _pack_rows(part: pa.Table) -> pa.RecordBatch:
    """The rows by length of ``_key``, ``PACKED`` in one: the keys' bytes and sizes, and every other column as a list."""
    size = pc.binary_length(part.column("_key")).to_numpy()
    order = np.argsort(np.minimum(size, 0xFFFF).astype(np.uint16), kind="stable")
    part, size = part.take(pa.array(order)).combine_chunks(), size[order].astype(np.uint32)
    at = np.r_[np.arange(0, len(size), PACKED), len(size)]
    bytes_ = lambda data, ends: pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data)])
    names = [c for c in part.column_names if c != "_key"]
    return pa.RecordBatch.from_arrays(
        [pa.array(np.diff(at), pa.int64()), bytes_(_joined(part.column("_key")), np.r_[0, np.cumsum(size, dtype=np.int64)][at]), bytes_(size, 4 * at),
         *[pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.concat_arrays(part.column(c).chunks)) for c in names]], ["n", "keys", "sizes", *names])


def _rows_of(part: pa.Table, column: str) -> pa.Array:
    return pa.concat_arrays(part.column(column).chunks).flatten()


def _range(hashes: np.ndarray, ranges: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)


def _meeting(df: DataFrame, features: Sequence[str], key: Sequence[str], repeats: int, seed, carry: Mapping[str, Column]):
    """The rows packed by ``_block`` (``carry``, ``_known``: no null in the key, ``_hi``, ``_lo``: halves of the own hash, ``_own0``...:
    the values), and what is sent to the blocks: packed values of a job from a place of the block on."""
    tails = [f"{f}|{r}|{seed}".encode() for f in features for r in range(repeats)]
    jobs = len(tails)
    known = reduce(Column.__and__, [col_of(c).isNotNull() for c in key], F.lit(True))
    text = F.concat_ws("|", *[col_of(c).cast("string") for c in key], F.lit("")).cast("binary")
    plain = spread(df, *[col_of(c) for c in dict.fromkeys([*key, *features])]).select(
        *[c.alias(n) for n, c in carry.items()], *[col_of(f).cast("double").alias(f"_own{i}") for i, f in enumerate(features)], known.alias("_known"), text.alias("_key"))
    packed = StructType([*StructType().add("n", "long").add("keys", "binary").add("sizes", "binary").fields,
                         *[StructField(f.name, ArrayType(f.dataType)) for f in plain.drop("_key").schema]])
    rows = run_table(plain.mapInArrow(lambda batches: map(_pack_rows, _buffered(batches, ROWS)), packed))
    total = int(rows.agg(F.sum("n")).first()[0] or 0)
    blocks, ranges = max(1, -(-total * jobs // BLOCK_VALUES)), max(1, -(-total // BLOCK_VALUES))

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(blocks, dtype=np.int64)
        for part in _buffered(batches, ROWS // PACKED):
            count += np.bincount(_range(_Keys(part).hashed(str(seed).encode())[:, 0], blocks), minlength=blocks)
        some = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(count[some], pa.int64())], ["_block", "n"])

    counts = np.zeros(blocks, dtype=np.int64)
    for r in rows.select("keys", "sizes").mapInArrow(tally, "_block long, n long").groupBy("_block").agg(F.sum("n").alias("n")).collect():  # one number per block
        counts[r["_block"]] = r["n"]
    starts = np.r_[0, np.cumsum(counts)]

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for packed in _buffered(batches, ROWS // PACKED):
            h = _Keys(packed).hashed(str(seed).encode())
            order = _ordered(h[:, 0].copy())
            h = h[order]
            names = [c for c in packed.column_names if c not in ("n", "keys", "sizes")]
            part = pa.table([_rows_of(packed, c) for c in names], names=names).take(pa.array(order))
            part = part.append_column("_hi", pa.array(h[:, 0].copy())).append_column("_lo", pa.array(h[:, 1].copy())).combine_chunks()
            to = _range(h[:, 0], blocks)
            cuts = np.r_[np.flatnonzero(np.r_[True, to[1:] != to[:-1]]), len(to)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(to[cuts[:-1]], pa.int64()), pa.array([_written(part.slice(a, z - a)) for a, z in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary())],
                ["_block", "rows"])

    def deal(some: range):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in _buffered(batches, ROWS // PACKED):
                yield from one(_Keys(part), part)

        def one(keys: _Keys, part: pa.Table) -> Iterator[pa.RecordBatch]:
            at = -1
            for job in some:
                if at != job // repeats:
                    at = job // repeats
                    known, values = _coded(_bits(_rows_of(part, f"_own{at}")))
                h = keys.hashed(tails[job])[:, 0].copy()
                order = _ordered(h)
                h, v = h[order], values[order]
                to = _range(h, ranges)
                cuts = np.r_[np.flatnonzero(np.r_[True, to[1:] != to[:-1]]), len(h)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(cuts) - 1, job), pa.int32()), pa.array(to[cuts[:-1]]),
                     pa.array([_pack_sorted(h[a:z]) for a, z in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary()),
                     pa.array([_pack_coded(known, v[a:z]) for a, z in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary())], ["job", "part", "hashes", "vals"])
        return run

    def ordered(found: tuple, chunks: pa.Table) -> pa.Table:
        h = np.concatenate([_unpack_sorted(x) for x in chunks.column("hashes").to_pylist()])
        coded = [_unpack_coded(x) for x in chunks.column("vals").to_pylist()]
        known = np.unique(np.concatenate([np.unique(c) if k is None else k for k, c in coded]))
        if len(known) <= CODES:
            v = np.concatenate([np.searchsorted(known, c).astype(np.uint8) if k is None else np.searchsorted(known, k).astype(np.uint8)[c] for k, c in coded])
        else:
            known, v = None, np.concatenate([c if k is None else k[c] for k, c in coded])
        del coded
        v = v[_ordered(h, v)]  # equal keys: by value, so that a task run again does the same
        return pa.table({"job": pa.array([found[0].as_py()], pa.int32()), "part": pa.array([found[1].as_py()], pa.int64()),
                         "n": pa.array([len(v)], pa.int64()), "vals": pa.array([_pack_coded(known, v)], pa.binary())})

    each = max(1, ROUND // max(total, 1))
    rounds = []
    for at in range(0, max(jobs, 1), each):
        some = range(at, min(at + each, jobs))
        dealt = rows.select("keys", "sizes", *dict.fromkeys(f"_own{j // repeats}" for j in some)).mapInArrow(deal(some), "job int, part long, hashes binary, vals binary")
        rounds.append(run_table(dealt.groupBy("job", "part").applyInArrow(ordered, "job int, part long, n long, vals binary")))
        del dealt
        if jobs > each:  # lets Spark's cleaner delete the round's shuffle files
            gc.collect()
            df.sparkSession.sparkContext._jvm.System.gc()
    sorted_ = reduce(DataFrame.unionByName, rounds)
    sizes = np.zeros((jobs, ranges), dtype=np.int64)
    for r in sorted_.select("job", "part", "n").collect():  # one number per job and range
        sizes[r["job"], r["part"]] = r["n"]
    first = np.cumsum(sizes, axis=1) - sizes

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for job, part, packed in zip(*(batch.column(c).to_pylist() for c in ("job", "part", "vals")), strict=True):
                (known, v), at = _unpack_coded(packed), int(first[job, part])
                to = np.arange(np.searchsorted(starts, at, "right") - 1, np.searchsorted(starts, at + len(v), "left"))
                to = to[counts[to] > 0]
                lo, hi = np.maximum(starts[to], at), np.minimum(starts[to + 1], at + len(v))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(to, pa.int64()), pa.array(np.full(len(to), job), pa.int32()), pa.array(lo - starts[to], pa.int64()),
                     pa.array([_pack_coded(known, v[a - at:z - at]) for a, z in zip(lo, hi, strict=True)], pa.binary())], ["_block", "job", "at", "vals"])

    sent = sorted_.select("job", "part", "vals").mapInArrow(send, "_block long, job int, at long, vals binary")
    return rows.mapInArrow(split, "_block long, rows binary").groupBy("_block").cogroup(sent.groupBy("_block"))


def _met(mine: pa.Table, pieces: pa.Table, jobs: int) -> tuple[pa.Table, np.ndarray, np.ndarray | slice, np.ndarray | slice]:
    """Rows of a block in their order, job x row of what they receive, and the rows that meet: receiver and place of the value."""
    mine = pa.concat_tables([_read(x) for x in mine.column("rows").to_pylist()])
    h = [mine.column(c).to_numpy() for c in ("_hi", "_lo")]
    order = np.lexsort((h[1], h[0]))
    mine, n = mine.take(pa.array(order)).combine_chunks(), len(order)
    got = np.full((jobs, n), NULL, dtype=np.int64)
    for job, at, packed in zip(*(pieces.column(c).to_pylist() for c in ("job", "at", "vals")), strict=True):
        v = _unpack(packed)
        got[job, at:at + len(v)] = v
    other = np.ones(n, dtype=bool)
    other[1:] = (h[0][order[1:]] != h[0][order[:-1]]) | (h[1][order[1:]] != h[1][order[:-1]])
    known = mine.column("_known").to_numpy().astype(bool)
    if other.all() and known.all():
        return mine, got, slice(None), slice(None)
    # rows of equal key, which lie together, meet as in a join
    begin = np.flatnonzero(other)
    size = np.diff(np.r_[begin, n])
    many, start = np.repeat(size, size), np.repeat(begin, size)
    left = np.repeat(np.arange(n), many)
    right = np.repeat(start, many) + np.arange(len(left)) - np.repeat(np.cumsum(many) - many, many)
    keep = known[left] & known[right]
    return mine, got, left[keep], right[keep]


def permutation_pairs(df: DataFrame, features: Sequence[str], key: Sequence[str], repeats: int, seed=42, carry: Sequence[str] = ()) -> DataFrame:
    """key..., carry..., feature, repeat, original, permuted: one row per receiver and job."""
    features, names = list(features), [*key, *carry]
    jobs = len(features) * repeats
    fields = [StructField(f"_c{i}", df.select(col_of(c)).schema[0].dataType) for i, c in enumerate(names)]
    out = StructType([*fields, StructField("_own", ArrayType(DoubleType())), StructField("_got", ArrayType(DoubleType()))])

    def meet(mine: pa.Table, pieces: pa.Table) -> pa.Table:
        mine, got, left, right = _met(mine, pieces, jobs)
        own = np.stack([_bits(mine.column(f"_own{i}")) for i in range(len(features))], axis=1) if features else np.zeros((mine.num_rows, 0), dtype=np.int64)
        taken = mine if isinstance(left, slice) else mine.take(pa.array(left))
        return pa.table([*[taken.column(f.name) for f in fields], _lists(own[left]), _lists(got.T[right])], names=out.fieldNames())

    met = _meeting(df, features, key, repeats, seed, {f"_c{i}": col_of(c) for i, c in enumerate(names)}).applyInArrow(meet, out)
    place = F.floor(F.col("_job") / max(repeats, 1)).cast("int")
    named = F.array(*[F.lit(f) for f in features]) if features else F.lit(None).cast("array<string>")
    return (met.select(*[F.col(f"_c{i}").alias(c) for i, c in enumerate(names)], "_own", F.posexplode("_got").alias("_job", "permuted"))
            .select(*names, named[place].alias("feature"), (F.col("_job") % max(repeats, 1)).alias("repeat"), F.col("_own")[place].alias("original"), "permuted"))


def permuted_cells(df: DataFrame, weights: Mapping[str, float], z: Column, label: Column, key: Sequence[str], repeats: int, seed=42,
                   digits: int = 9) -> DataFrame:
    """feature, repeat, label, prediction, n of every pair of :func:`permutation_pairs` when a linear scorer takes the permuted value:
    the score is that of ``z + w (permuted - original)``, rounded to ``digits``, the prediction 1 from 0.5 on. A null among
    label, score and values counts nowhere. Rows without a feature count all rows as they are. Cells come per block, to be added up."""
    features, w = list(weights), [float(x) for x in weights.values()]
    jobs = len(features) * repeats
    lowest = 0.5 if digits < 1 else float(f"0.4{'9' * (digits - 1)}5")  # the least double that is rounded to 0.5

    def cells(z: np.ndarray, y: np.ndarray, bad: np.ndarray) -> np.ndarray:
        with np.errstate(all="ignore"):
            score = 1.0 / (1.0 + np.exp(-z))
        cell = 2 * y + ((score >= lowest) | np.isnan(score))  # NaN is above all numbers
        return np.bincount(cell[~bad] if bad.any() else cell, minlength=4)

    def meet(mine: pa.Table, pieces: pa.Table) -> pa.Table:
        mine, got, left, right = _met(mine, pieces, jobs)
        z, y = mine.column("z"), mine.column("label")
        bad = ~(z.is_valid().to_numpy() & y.is_valid().to_numpy())
        z, y = z.fill_null(0.0).to_numpy(), y.fill_null(0).to_numpy().astype(np.int64)
        count = np.zeros((jobs + 1, 4), dtype=np.int64)
        count[jobs] = cells(z, y, bad)
        z, y, bad = z[left], y[left], bad[left]
        for i in range(len(features)):
            own = _bits(mine.column(f"_own{i}"))[left]
            lost = bad | (own == NULL)
            for job in range(i * repeats, (i + 1) * repeats):
                theirs = got[job, right]
                with np.errstate(all="ignore"):
                    count[job] = cells(z + w[i] * (theirs.view(np.float64) - own.view(np.float64)), y, lost | (theirs == NULL))
        job, cell = np.divmod(np.arange(4 * (jobs + 1)) if len(z) else np.arange(4 * jobs, 4 * (jobs + 1)), 4)
        return pa.table({"job": pa.array(job, pa.int32()), "label": pa.array(cell // 2, pa.int32()), "prediction": pa.array(cell % 2, pa.int32()),
                         "n": pa.array(count[job, cell], pa.int64())})

    met = _meeting(df, features, key, repeats, seed, {"label": F.when(label == 1, 1).when(label == 0, 0), "z": z.cast("double")}).applyInArrow(
        meet, "job int, label int, prediction int, n long")
    named = F.array(*[F.lit(f) for f in features]) if features else F.lit(None).cast("array<string>")
    mine = F.col("job") < jobs
    return met.select(F.when(mine, named[F.floor(F.col("job") / max(repeats, 1)).cast("int")]).alias("feature"),
                      F.when(mine, F.col("job") % max(repeats, 1)).alias("repeat"), "label", "prediction", "n")
