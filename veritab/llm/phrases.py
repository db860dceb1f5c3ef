"""Operator 11: collocations from depth-truncated suffix subtrees, partitioned vertically by word
prefixes under a memory budget.

A symbol is the 64-bit hash of a language and a word. The steps:

1. Words. Occurrences of every (language, word) are counted; only words with ``LEAST`` occurrences can
   be in a phrase that has as many. A bitmap of fixed size, filled with their hashes, is broadcast (a
   wrong hit costs work, not rightness).
2. Vertical partitioning. A prefix whose occurrences exceed ``BUDGET`` is lengthened by a word, by one
   scan per length that counts the longer prefixes, until every prefix fits the budget or has
   ``DEPTH`` words. The fitting prefixes are dealt by hash range into groups of about the budget; the
   table of cuts and the prefixes to lengthen have at most a few entries per budget of words.
3. Subtrees. Tasks cut the suffixes after ``DEPTH`` words, at the end of their piece and before a word
   that is too rare, merge equal ones (leaves with weights) and send them packed to their group. A
   group's subtree is built alone: sorted leaves, common prefixes with the neighbour, and a node's
   count is the total of its leaves. The groups are built in ``ROUNDS`` rounds, one scan each, so that only
   the leaves of one round are on disk at a time.
4. Scores. Phrase counts meet their parts, and longer candidates their inner phrases, by equi-joins
   on the symbols; arithmetic is in decimals. The first rows of every language are taken from the first
   of ``SALTS`` parts, so no task ranks a whole language.

Texts are read in pieces of about 1 MiB that end at a word's end, with the words before a cut kept, so
memory does not depend on the longest text.

Defined results: a null or empty text has no words; a null language counts as ``und``; repeated rows count
each; a language without candidates gives no rows, as does an empty table. Only text and lang are
read, so other columns may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import Scratch, table
from .words import PIECE, _tables, mix, pieces_of_rows, text_buffers

#: Words of the longest phrase; fewest occurrences; percent of a phrase's occurrences inside a longer one
#: that drops it; rows returned per language.
DEPTH, LEAST, INSIDE, FIRST = 4, 30, 80, 2000
#: Suffixes of a group; words cut into suffixes at once; leaves packed at once; rounds in which the groups
#: are built; bits of the bitmap of frequent words; parts of a ranking.
BUDGET, FLUSH, HOLD, ROUNDS, BITMAP_BITS, SALTS = 2_000_000, 500_000, 2_000_000, 2, 23, 64

_SPACE, _CUT = b" \t", b".,;:!?\n\x0b\x0c\r"


def _kinds() -> np.ndarray:
    """0 for a byte of a word, 1 for space, 2 for the end of a piece."""
    kind = np.zeros(256, dtype=np.uint8)
    kind[list(_SPACE)] = 1
    kind[list(_CUT)] = 2
    return kind


def _tag(lang: str) -> np.uint64:
    return np.uint64(int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little"))


def words_in(data: np.ndarray, rows: np.ndarray, tags: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(symbol, piece number, first byte, end) of every word of rows that start at ``rows``."""
    t = _tables()
    kind = _kinds()[data]
    solid = kind == 0
    before = np.r_[False, solid[:-1]] if len(data) else solid
    inner = rows[(rows > 0) & (rows < len(data))]
    before[inner] = False
    starts = np.flatnonzero(solid & ~before)
    after = np.r_[solid[1:], False] if len(data) else solid
    after[inner - 1] = False
    ends = np.flatnonzero(solid & ~after) + 1
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(t["value"][data] * t["power"][np.arange(len(data)) % PIECE] if len(data) > PIECE else t["value"][data] * t["power"][:len(data)],
              out=sums[1:])
    if len(data) > PIECE:  # one very long word among others: hash each by itself
        hashes = np.array([_long_word(data[a:z]) for a, z in zip(starts, ends, strict=True)], dtype=np.uint64)
    else:
        hashes = (sums[ends] - sums[starts]) * t["inverse"][starts]
    cuts = np.cumsum(kind == 2)
    row = np.searchsorted(rows, starts, side="right") - 1
    return mix(mix(hashes) ^ tags[row]), cuts[starts] + row, starts, ends


def _long_word(word: np.ndarray) -> np.uint64:
    """The polynomial of ``words_in`` for a word of any length."""
    t, total, scale = _tables(), np.uint64(0), np.uint64(1)
    with np.errstate(over="ignore"):
        for at in range(0, len(word), PIECE):
            part = word[at:at + PIECE]
            total += scale * np.sum(t["value"][part] * t["power"][:len(part)], dtype=np.uint64)
            scale *= t["power"][PIECE]
    return total


def _word_ends(data: np.ndarray) -> Iterator[tuple[int, int]]:
    """Byte ranges of about PIECE bytes of a long text that end before a byte outside words."""
    kind, at = _kinds(), 0
    while at < len(data):
        end = min(at + PIECE, len(data))
        while end < len(data):
            found = np.flatnonzero(kind[data[end:end + PIECE]])
            if len(found):
                end += int(found[0])
                break
            end = min(end + PIECE, len(data))
        yield at, end
        at = end


def symbol_runs(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, bool]]:
    """(symbol, piece, first byte, end, row of the batch, bytes, continued) of all words, a MiB at a time;
    ``continued``: the text goes on in the next part."""
    body, offsets = text_buffers(batch.column("text"))
    tags = {}
    langs = batch.column("lang").to_pylist()
    own = np.array([tags.setdefault(x, _tag(x)) for x in langs], dtype=np.uint64)
    for a, b in pieces_of_rows(offsets):
        low, high = int(offsets[a]), int(offsets[b])
        if high - low <= PIECE:
            data = body[low:high]
            rows = (offsets[a:b] - low).astype(np.int64)
            symbol, piece, first, end = words_in(data, rows, own[a:b])
            yield symbol, piece, first, end, a + np.searchsorted(rows, first, side="right") - 1, data, False
            continue
        pieces = 0
        for at, end_ in _word_ends(body[low:high]):
            data = body[low + at:low + end_]
            symbol, piece, first, end = words_in(data, np.zeros(1, np.int64), own[a:a + 1])
            yield symbol, piece + pieces, first, end, np.full(len(symbol), a), data, end_ < high - low
            pieces += int((_kinds()[data] == 2).sum())


def _word_rows(docs: DataFrame) -> DataFrame:
    """(symbol, lang, word, n): words of each part of a task, counted; word null: all words of a language."""
    names, kinds = ["symbol", "lang", "word", "n"], [pa.int64(), pa.string(), pa.binary(), pa.int64()]
    lower = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            totals: dict[str, int] = {}
            for symbol, _, first, end, row, data, _ in symbol_runs(batch):
                if not len(symbol):
                    continue
                own, at, n = np.unique(symbol, return_index=True, return_counts=True)
                raw = data.tobytes().translate(lower)
                words = [raw[x:y] for x, y in zip(first[at].tolist(), end[at].tolist(), strict=True)]
                there = [langs[r] for r in row[at].tolist()]
                for lang, many in zip(there, n.tolist(), strict=True):
                    totals[lang] = totals.get(lang, 0) + many
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip((own.view(np.int64), there, words, n), kinds, strict=True)], names)
            rows = list(zip(*[(0, lang, None, n) for lang, n in totals.items()], strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds, strict=True)], names)

    return docs.mapInArrow(run, "symbol long, lang string, word binary, n long")


def _hash(symbols: list[np.ndarray]) -> np.ndarray:
    """Hash of a prefix of symbols."""
    out = mix(symbols[0])
    for s in symbols[1:]:
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + s)
    return out


def _has(bitmap: np.ndarray, symbols: np.ndarray) -> np.ndarray:
    slot = symbols >> np.uint64(64 - BITMAP_BITS)
    return (bitmap[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 > 0


def _suffixes(symbol: np.ndarray, piece: np.ndarray, bitmap: np.ndarray, whole: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(table of symbols, keys, weights) of the different truncated suffixes of at least two words among the
    first ``whole`` words. A key holds numbers of 16 bits into the table, whose first entry, 0, is no word."""
    frequent = _has(bitmap, symbol)
    table_, number = np.unique(symbol[frequent], return_inverse=True)
    if len(table_) >= (1 << 16) - 1:  # halves, until numbers of 16 bits do
        half = whole // 2
        yield from _suffixes(symbol[:half + DEPTH - 1], piece[:half + DEPTH - 1], bitmap, half)
        yield from _suffixes(symbol[half:], piece[half:], bitmap, whole - half)
        return
    code = np.zeros(len(symbol) + DEPTH, dtype=np.uint64)
    code[np.flatnonzero(frequent)] = number.astype(np.uint64) + np.uint64(1)
    group = np.r_[piece, np.full(DEPTH, -1)]
    key, going = code[:whole].copy(), code[:whole] > 0
    for k in range(1, DEPTH):
        going &= (code[k:whole + k] > 0) & (group[k:whole + k] == group[:whole])
        key = (key << np.uint64(16)) | np.where(going, code[k:whole + k], np.uint64(0))
    key = key[(key >> np.uint64(16 * (DEPTH - 2))) & np.uint64(0xFFFF) > 0]
    if len(key):
        yield np.r_[np.zeros(1, np.uint64), table_], *np.unique(key, return_counts=True)


def _column(key: np.ndarray, k: int) -> np.ndarray:
    """Numbers of the k-th words of keys."""
    return (key >> np.uint64(16 * (DEPTH - 1 - k))) & np.uint64(0xFFFF)


def _leaves(batches: Iterator[pa.RecordBatch], bitmap: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The leaves of about FLUSH words at a time, as ``_suffixes`` gives them."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size, offset = 0, 0
    for batch in batches:
        for symbol, piece, _, _, _, _, continued in symbol_runs(batch):
            held.append((symbol, piece + offset))
            size += len(symbol)
            if not continued:
                offset += int(piece[-1]) + 1 if len(piece) else 0
            if size >= FLUSH:
                symbols, pieces = (np.concatenate(x) for x in zip(*held, strict=True))
                whole = len(symbols) - (DEPTH - 1) if continued else len(symbols)
                yield from _suffixes(symbols, pieces, bitmap, whole)
                held = [(symbols[whole:], pieces[whole:])]
                size = len(symbols) - whole
    if size:
        symbols, pieces = (np.concatenate(x) for x in zip(*held, strict=True))
        yield from _suffixes(symbols, pieces, bitmap, len(symbols))


def _counted_prefixes(docs: DataFrame, bitmap: object, heavy: object, length: int) -> DataFrame:
    """(p, n): prefixes of ``length`` words whose first length - 1 words are a heavy prefix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for symbols, key, weight in _leaves(batches, bitmap.value):
            columns = [symbols[_column(key, k)] for k in range(length)]
            take = np.isin(_hash(columns[:length - 1]), heavy.value) & (columns[length - 1] > 0)
            if not take.any():
                continue
            rows = np.stack([c[take] for c in columns[:length]], axis=1)
            order = np.lexsort(rows.T[::-1])
            rows, weight = rows[order], weight[take][order]
            first = np.flatnonzero(np.r_[True, (rows[1:] != rows[:-1]).any(axis=1)])
            flat = pa.array(rows[first].ravel().view(np.int64))
            p = pa.ListArray.from_arrays(pa.array(np.arange(0, len(first) * length + 1, length, dtype=np.int32)), flat)
            yield pa.RecordBatch.from_arrays([p, pa.array(np.add.reduceat(weight, first).astype(np.int64))], ["p", "n"])

    return docs.mapInArrow(run, "p array<long>, n long").groupBy("p").agg(F.sum("n").alias("n"))


def _prefix_hash(p: DataFrame) -> DataFrame:
    """Adds ``h``, the hash of the prefix as the subtree tasks compute it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column("p")
            length = len(rows[0]) if len(rows) else 1
            flat = rows.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64).reshape(-1, length)
            h = _hash([np.ascontiguousarray(flat[:, k]) for k in range(length)])
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), batch.column("n")], ["h", "n"])

    return p.select("p", "n").mapInArrow(run, "h long, n long")


def _unsigned(values: list[int]) -> np.ndarray:
    return np.sort(np.array(values, dtype=np.int64).view(np.uint64))


def groups_of(columns: list[np.ndarray], heavy: list[np.ndarray], cuts: np.ndarray, bits: int) -> np.ndarray:
    """Group of every suffix: that of its shortest prefix which is not heavy."""
    h = _hash(columns[:1])
    for length in range(1, DEPTH):
        if length > len(heavy) or not len(heavy[length - 1]):
            break
        longer = np.isin(h, heavy[length - 1])
        if not longer.any():
            break
        h[longer] = _hash([c[longer] for c in columns[:length + 1]])
    return np.searchsorted(cuts, h >> np.uint64(64 - bits), side="right")


def _planes(values: np.ndarray) -> bytes:
    """Rows of numbers, compressed by byte planes: small numbers cost little."""
    wide = values.dtype.itemsize
    bytes_ = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1, wide).transpose(0, 2, 1))
    return pa.compress(bytes_.tobytes(), codec="zstd", asbytes=True)


def _unplanes(data: bytes, rows: int, n: int, kind: type) -> np.ndarray:
    wide = np.dtype(kind).itemsize
    raw = np.frombuffer(pa.decompress(data, rows * n * wide, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(raw.reshape(rows, wide, n).transpose(0, 2, 1)).view(kind).reshape(rows, n)


def _pack(held: list[tuple[np.ndarray, np.ndarray, np.ndarray]], heavy: list[np.ndarray], cuts: np.ndarray, bits: int, turn: int) -> Iterator[tuple]:
    """(part, symbols, leaves, codes, weights) of the leaves held whose group is built in this turn, one
    row per group.

    Words are numbered by falling frequency, so that most numbers are small."""
    symbols, number = np.unique(np.concatenate([t for t, _, _ in held]), return_inverse=True)
    at = np.cumsum([0, *(len(t) for t, _, _ in held)])
    number = number.astype(np.uint32)
    columns = [np.concatenate([number[x:][_column(key, k)] for x, (_, key, _) in zip(at, held, strict=False)]) for k in range(DEPTH)]
    weight = np.concatenate([w for _, _, w in held])
    often = np.bincount(np.concatenate(columns), minlength=len(symbols))
    often[0] = often.max() + 1  # no word stays number 0
    rank = np.empty(len(symbols), dtype=np.uint32)
    order = np.argsort(-often, kind="stable")
    rank[order] = np.arange(len(symbols), dtype=np.uint32)
    symbols, columns = symbols[order], [rank[c] for c in columns]
    # a suffix that ends within a heavy prefix is already counted
    known = np.zeros(len(weight), dtype=bool)
    for length in range(1, min(len(heavy), DEPTH - 1) + 1):
        if len(heavy[length - 1]):
            known |= np.isin(_hash([symbols[c] for c in columns[:length]]), heavy[length - 1]) & (columns[length] == 0)
    part = groups_of([symbols[c] for c in columns], heavy, cuts, bits)
    take = ~known & (part % ROUNDS == turn)
    columns, weight, part = [c[take] for c in columns], weight[take], part[take].astype(np.uint64)
    first, second = (part << np.uint64(32)) | columns[0], (columns[1].astype(np.uint64) << np.uint64(32)) | columns[2]
    order = np.lexsort((columns[3], second, first))
    columns, part, weight = [c[order] for c in columns], part[order], weight[order]
    new = np.r_[True, np.any([c[1:] != c[:-1] for c in columns], axis=0)] if len(weight) else np.zeros(0, bool)
    weight = np.add.reduceat(weight, np.flatnonzero(new)) if len(weight) else weight
    columns, part = [c[new] for c in columns], part[new]
    edges = np.flatnonzero(np.r_[True, part[1:] != part[:-1], True]) if len(part) else np.zeros(1, int)
    for x, y in zip(edges[:-1], edges[1:], strict=True):
        codes = np.stack([c[x:y] for c in columns])
        used = np.zeros(len(symbols), dtype=bool)
        used[0] = used[codes.ravel()] = True
        own = np.cumsum(used) - 1
        kind = np.uint16 if int(own[-1]) < 1 << 16 else np.uint32
        yield (int(part[x]), symbols[used].tobytes(), int(y - x), _planes(own[codes].astype(kind)), _planes(weight[None, x:y].astype(np.int64)))


def _packed_leaves(docs: DataFrame, bitmap: object, plan: object, turn: int) -> DataFrame:
    """Leaves of every group of a turn as ``_pack`` gives them, about HOLD at a time."""
    names, kinds = ["part", "symbols", "leaves", "codes", "weights"], [pa.int64(), pa.binary(), pa.int64(), pa.binary(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pack(held: list) -> pa.RecordBatch:
            rows = list(zip(*_pack(held, *plan.value, turn), strict=True)) or [()] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds, strict=True)], names)

        held, size = [], 0
        for leaves in _leaves(batches, bitmap.value):
            held.append(leaves)
            size += len(leaves[1])
            if size >= HOLD:
                yield pack(held)
                held, size = [], 0
        if held:
            yield pack(held)

    return docs.mapInArrow(run, "part long, symbols binary, leaves long, codes binary, weights binary")


def subtree(columns: list[np.ndarray], weight: np.ndarray, least: int = LEAST) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per depth from 2: (symbols of every node with at least ``least`` occurrences, occurrences).

    ``columns``: symbols of the leaves by depth, 0 for none. Leaves are sorted; a node of depth d begins
    where the common prefix with the leaf before is shorter than d; its count is its leaves' total."""
    order = np.lexsort(columns[::-1])
    columns, weight = [c[order] for c in columns], weight[order].astype(np.int64)
    prefix = np.zeros(len(weight), dtype=np.int8)  # common prefix with the leaf before, in words
    same = np.r_[False, np.ones(max(len(weight) - 1, 0), dtype=bool)][:len(weight)]
    for c in columns:
        same[1:] &= (c[1:] == c[:-1])
        prefix += same
    out = []
    for depth in range(2, len(columns) + 1):
        first = np.flatnonzero(prefix < depth)
        total = np.add.reduceat(weight, first)
        kept = (total >= least) & (columns[depth - 1][first] > 0)
        out.append((np.stack([c[first[kept]] for c in columns[:depth]], axis=1), total[kept]))
    return out


def _subtrees(leaves: DataFrame, least: int) -> DataFrame:
    """(p, n) of every node of depth 2 or more below the groups' prefixes."""

    def build(part: pa.Table) -> pa.Table:
        columns: list[list[np.ndarray]] = [[] for _ in range(DEPTH)]
        weights = []
        for s, n, c, w in zip(*(part.column(x).to_pylist() for x in ("symbols", "leaves", "codes", "weights")), strict=True):
            symbols = np.frombuffer(s, np.uint64)
            codes = _unplanes(c, DEPTH, n, np.uint16 if len(symbols) <= 1 << 16 else np.uint32)
            for k in range(DEPTH):
                columns[k].append(symbols[codes[k]])
            weights.append(_unplanes(w, 1, n, np.int64)[0])
        nodes = subtree([np.concatenate(c) for c in columns], np.concatenate(weights), least)
        lists = [x for p, _ in nodes for x in p.view(np.int64).tolist()]
        return pa.table({"p": pa.array(lists, pa.list_(pa.int64())), "n": pa.array(np.concatenate([n for _, n in nodes]), pa.int64())})

    return leaves.groupBy("part").applyInArrow(lambda part: build(part), "p array<long>, n long")


def phrase_counts(scratch: Scratch, docs: DataFrame, least: int = LEAST, budget: int = BUDGET) -> tuple[DataFrame, DataFrame, DataFrame]:
    """((p, n) of every word and phrase of up to DEPTH words with at least ``least`` occurrences, where p
    holds symbols; (symbol, lang, word) of the words among them; (lang, n) of all words)."""
    spark = scratch.spark
    context = spark.sparkContext
    docs = docs.select(F.coalesce("text", F.lit("")).alias("text"), F.coalesce("lang", F.lit("und")).alias("lang"))
    words = scratch.save(_word_rows(docs).groupBy("symbol", "lang", "word").agg(F.sum("n").alias("n"))
                         .where((F.col("n") >= least) | F.col("word").isNull()), "words")
    totals = words.where("word is null").select("lang", "n")
    words = words.where("word is not null")
    counts = [words.select(F.array("symbol").alias("p"), "n")]

    slots = words.select(F.shiftrightunsigned("symbol", 64 - BITMAP_BITS).alias("slot")).distinct().toPandas()["slot"].to_numpy(np.int64)
    bitmap = np.zeros((1 << BITMAP_BITS) >> 3, dtype=np.uint8)
    np.bitwise_or.at(bitmap, slots >> 3, np.uint8(1) << (slots & 7).astype(np.uint8))
    bitmap = context.broadcast(bitmap)

    # vertical partitioning: loads of the prefixes that fit, by hash range; the others are lengthened
    total = int(totals.agg(F.sum("n")).first()[0] or 0)
    bits = max(12, (8 * total // budget).bit_length())
    loads, heavy, level = np.zeros(1 << bits, dtype=np.int64), [], counts[0]
    for length in range(1, DEPTH + 1):
        hashed = _prefix_hash(level)
        fits = hashed.where(F.col("n") <= budget) if length < DEPTH else hashed
        for row in fits.groupBy(F.shiftrightunsigned("h", 64 - bits).alias("slot")).agg(F.sum("n").alias("n")).collect():
            loads[row["slot"]] += row["n"]  # at most 2^bits rows, a few per budget of words
        if length == DEPTH:
            break
        # prefixes beyond the budget: at most total / budget of them
        heavy.append(_unsigned([r["h"] for r in hashed.where(F.col("n") > budget).select("h").collect()]))
        if not len(heavy[-1]):
            break
        level = scratch.save(_counted_prefixes(docs, bitmap, context.broadcast(heavy[-1]), length + 1), f"prefixes-{length + 1}")
        counts.append(level.where(F.col("n") >= least))
    cuts = np.flatnonzero(np.diff(np.cumsum(loads) // budget)) + 1
    plan = context.broadcast((heavy, cuts.astype(np.uint64), bits))

    turns = []
    for turn in range(ROUNDS):
        turns.append(scratch.save(_subtrees(_packed_leaves(docs, bitmap, plan, turn), least), f"nodes-{turn}"))
        scratch.release()
    nodes = _all(turns)
    # a heavy prefix and its extensions may also be a node of a subtree; both have its whole count
    phrases = nodes.union(_all(counts[1:])) if counts[1:] else nodes
    phrases = phrases.groupBy("p").agg(F.max("n").alias("n"))
    return counts[0].union(phrases), words.select("symbol", "lang", "word"), totals


def _all(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.union(f)
    return out


def _decimal(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(20,0)")


def collocations(docs: DataFrame, least: int = LEAST, first: int = FIRST, budget: int = BUDGET) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first ``first`` phrases."""
    scratch = Scratch(docs.sparkSession, "phrases")
    counts, words, totals = phrase_counts(scratch, docs, least, budget)
    counts = scratch.save(counts, "counts")
    candidates = counts.where(F.size("p") > 1).select("p", F.col("n").alias("a"))

    # the cut with the lowest score
    size = F.size("p")
    parts = (candidates.select("p", "a", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
             .select("p", "a", "k", F.slice("p", F.lit(1), F.col("k")).alias("left"), F.slice("p", F.col("k") + 1, size - F.col("k")).alias("right")))
    scored = (parts.join(counts.select(F.col("p").alias("left"), F.col("n").alias("l")), "left")
              .join(counts.select(F.col("p").alias("right"), F.col("n").alias("r")), "right")
              .withColumn("x", F.lit(2_000_000).cast("decimal(8,0)") * _decimal("a"))
              .withColumn("y", _decimal("l") + _decimal("r"))
              .select("p", "a", F.struct(F.expr("x div y").alias("score"), "k", "l", "r").alias("cut"))
              .groupBy("p").agg(F.max("a").alias("a"), F.min("cut").alias("cut")))

    # candidates that mostly stand inside a longer one
    inner = (candidates.where(F.size("p") > 2)
             .select("a", F.explode(F.flatten(F.transform(F.sequence(F.lit(2), size - 1), lambda m: F.transform(
                 F.sequence(F.lit(1), size - m + 1), lambda i: F.slice(F.col("p"), i, m))))).alias("p"))
             .groupBy("p").agg(F.max("a").alias("most")))
    kept = (scored.join(inner, "p", "left")
            .where(F.col("most").isNull() | (F.lit(100) * _decimal("most") < F.lit(INSIDE) * _decimal("a")))
            .select("p", "a", "cut.*"))

    text = (kept.select("p", F.posexplode("p").alias("at", "symbol")).join(words, "symbol")
            .groupBy("p").agg(F.min("lang").alias("lang"),
                              F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", F.col("word").cast("string").alias("word")))),
                                                       lambda x: x["word"]), " ").alias("phrase")))
    best = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    named = kept.join(text, "p").withColumn("salt", F.pmod(F.xxhash64("p"), F.lit(SALTS)))
    some = (named.withColumn("i", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*best))).where(F.col("i") <= first))
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long")).where(F.col("rank") <= first)
    return (ranked.join(totals, "lang")
            .select("lang", "rank", "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score")))


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


_GRAMS = "\nUNION ALL ".join(
    f"SELECT lang, array_to_string(w[i:i + {d - 1}], ' ') AS g, {d} AS d FROM (SELECT lang, w, unnest(range(1, len(w) - {d - 2})) AS i FROM pieces)"
    for d in range(1, DEPTH + 1))

OP11_SQL = f"""
WITH texts AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
pieces AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM texts),
grams AS ({_GRAMS}),
totals AS (SELECT lang, count(*) AS n FROM grams WHERE d = 1 GROUP BY 1),
f AS (SELECT lang, g, d, count(*) AS f FROM grams GROUP BY 1, 2, 3 HAVING count(*) >= {LEAST}),
c AS (SELECT lang, g, d, f AS a, string_split(g, ' ') AS w FROM f WHERE d > 1),
cuts AS (SELECT *, unnest(range(1, d)) AS k FROM c),
scored AS (
  SELECT cuts.lang, cuts.g, cuts.d, a, k, x.f AS l, y.f AS r, CAST((2000000::HUGEINT * a) // (x.f + y.f) AS BIGINT) AS score
  FROM cuts JOIN f x ON x.lang = cuts.lang AND x.d = k AND x.g = array_to_string(w[1:k], ' ')
            JOIN f y ON y.lang = cuts.lang AND y.d = cuts.d - k AND y.g = array_to_string(w[k + 1:], ' ')
  QUALIFY row_number() OVER (PARTITION BY cuts.lang, cuts.g ORDER BY score, k) = 1),
sizes AS (SELECT *, unnest(range(2, d)) AS m FROM c WHERE d > 2),
spots AS (SELECT *, unnest(range(1, d - m + 2)) AS i FROM sizes),
inner_phrases AS (SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS g, max(a) AS most FROM spots GROUP BY 1, 2),
kept AS (
  SELECT s.* FROM scored s LEFT JOIN inner_phrases i USING (lang, g)
  WHERE most IS NULL OR 100::HUGEINT * most < {INSIDE}::HUGEINT * a)
SELECT lang, rank, g AS phrase, a, l, r, n, score FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, g) AS rank FROM kept) JOIN totals USING (lang)
WHERE rank <= {FIRST}
"""
