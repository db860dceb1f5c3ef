"""Operator 5: bytes covered by a 400-byte string that occurs elsewhere, by column-wise
construction of a multi-string Burrows-Wheeler transform.

A transform of the whole collection needs as many passes over all of it as the longest text has
symbols. So the collection is first cut, without loss, into small ones:

1. Anchors. In every 400-byte string the 200-byte gram of smallest hash (leftmost on ties) is an
   anchor; equal strings have equal anchors at equal places. Only grams at two places or more
   matter. The segment of an anchor holds every 400-byte string with that gram in it: the bytes
   from 200 before its start to 400 after it.
2. Equal segments are one string with a count; a string that occurs twice is repeated as a whole.
3. The different segments of one gram form a collection. Its strings are read in symbols of 100
   bytes, at all 100 phases, each tagged with its gram and its place from the gram, so only strings
   at the same place can match and a text does not match itself. Round j inserts the j-th symbol
   from the right of every string at once: the transform gives the new suffixes' ranks, it and the
   common prefixes are then rewritten in one sequential pass. A suffix that shares 4 symbols with
   a neighbour starts a repeated 400-byte string.
4. A gram with more than ``CROWD`` different segments (a passage that very many documents share,
   at its edges) is split by the hash of each of its 400-byte strings instead, in packed arrays;
   so no collection, task or group grows with the number of copies.
5. Places of grams and segments are packed (``places``), and spans go to blocks of texts: what is found
   in a segment is kept for one place of it, as a segment at several places is repeated as a whole.

The sequential files of the published method are arrays here: a collection is bounded, and
executors share no local folder. Texts are read whole, in pieces of bounded size. Grams, symbols,
segments and texts are compared by 64-bit hashes (texts also by length).

Null texts are empty; texts shorter than 400 bytes have nothing to remove; repeated rows and equal
texts of 400 bytes or more are removed whole; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .places import blocks_for, by_text, dealt, merged, merged_by_text, packed, repeated_places, unpacked
from .shared import Scratch, fresh, shuffle_width, table
from .word_repeats import WORDS, repeated_words
from .words import _tables as _hash_tables
from .words import mix

#: Length of a repeated string, gram and symbol in bytes (the last divides the first).
LENGTH, GRAM, SYMBOL = 400, 200, 100
#: Different segments of one gram up to which they form a collection; segments per collection.
CROWD, COLLECTION = 20_000, 1_000
#: Bytes of a block of hashes of crowded grams.
BLOCK = 4 << 20
#: Bytes read at once; pieces overlap by LENGTH - 1.
READ = 1 << 19

_BEFORE = LENGTH - GRAM


def rolling(data: np.ndarray, size: int) -> np.ndarray:
    """64-bit hash of every run of ``size`` bytes."""
    t = _hash_tables()
    values = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(values[data] * t["power"][:len(data)], out=sums[1:])
    n = len(data) - size + 1
    return mix((sums[size:] - sums[:-size]) * t["inverse"][:n])


def _sliding_minimum(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, by running minima within blocks of that width."""
    n = len(x) - width + 1
    blocks = -(-len(x) // width)
    wide = np.full(blocks * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    wide[:len(x)] = x
    grid = wide.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1:width - 1 + n])


def anchors(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(gram hashes, positions) of a text's anchors, in ascending position."""
    grams, places = [], []
    low = np.uint64((1 << 20) - 1)
    for at in range(0, max(len(data) - LENGTH + 1, 0), READ):
        part = data[at:at + READ + LENGTH - 1]
        if len(part) < LENGTH:
            break
        found = rolling(part, GRAM)
        keys = (found & ~low) | np.arange(len(found), dtype=np.uint64)
        chosen = np.unique((_sliding_minimum(keys, LENGTH - GRAM + 1) & low).astype(np.int64))
        grams.append(found[chosen])
        places.append(chosen + at)
    if not grams:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    place, first = np.unique(np.concatenate(places), return_index=True)
    return np.concatenate(grams)[first], place


def insert_columns(symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Transform and common prefixes of a collection, one symbol per string and round.

    ``symbols``: string x column, numbers >= 0 in the first ``lengths`` columns. Returns per suffix
    in sorted order its string, its first column and the common prefix with the suffix before it.
    The empty suffixes, one per string, come first."""
    count = len(lengths)
    string, column = np.arange(count, dtype=np.int32), lengths.astype(np.int32)
    prefix = np.zeros(count, dtype=np.int32)
    transform = symbols[np.arange(count), np.maximum(lengths - 1, 0)].astype(np.int64)
    transform[lengths == 0] = -1
    rank = np.arange(count)
    for j in range(1, int(lengths.max(initial=0)) + 1):
        active = np.flatnonzero(lengths >= j)
        # ranks of all suffixes with one symbol more, from the transform
        has = np.flatnonzero(transform >= 0)
        order = np.sort((transform[has] << 32) | has) & 0xFFFFFFFF
        rank_of = np.empty(len(transform), dtype=np.int64)
        rank_of[order] = count + np.arange(len(order))
        place = rank_of[rank[active]]
        size = count + len(order)
        old = np.ones(size, dtype=bool)
        old[place] = False
        # common prefixes of the new suffixes and of those that now follow one
        touched = np.zeros(size + 1, dtype=bool)
        touched[place] = touched[place + 1] = True
        touched = np.flatnonzero(touched[count + 1:size]) + 1
        a, b = order[touched - 1], order[touched]
        same = transform[a] == transform[b]
        value = np.zeros(len(touched), dtype=np.int32)
        if same.any():
            spans = np.stack([a[same] + 1, b[same] + 1], axis=1).ravel()
            value[same] = 1 + np.minimum.reduceat(np.append(prefix, 0), spans)[::2]

        def spread(before: np.ndarray, new: np.ndarray | int, old: np.ndarray = old, place: np.ndarray = place) -> np.ndarray:
            out = np.empty(len(old), dtype=before.dtype)
            out[old] = before
            out[place] = new
            return out

        prefix = spread(prefix, 0)
        prefix[touched + count] = value
        string = spread(string, active)
        column = spread(column, lengths[active] - j)
        following = symbols[active, np.maximum(lengths[active] - j - 1, 0)].astype(np.int64)
        following[lengths[active] == j] = -1
        transform = spread(transform, following)
        rank[active] = place
    return string, column, prefix


def _tagged(hashes: np.ndarray, gram: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Symbols that differ unless gram, place from the gram and bytes agree."""
    return mix(hashes ^ mix(place.astype(np.int64).view(np.uint64) ^ gram.astype(np.int64).view(np.uint64)))


def _symbols_of(segments: list[bytes], before: np.ndarray, grams: np.ndarray, size: int,
                phases: tuple[int, int] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(tagged hash of every run of ``size`` bytes, its segment, its offset), of all phases or a
    range of them."""
    out: list[tuple] = []
    together = 1_000  # segments hashed in one buffer, which must not be longer than a piece
    for at in range(0, len(segments), together):
        part = segments[at:at + together]
        ends = np.cumsum([len(x) for x in part])
        starts = np.r_[0, ends[:-1]]
        own = np.arange(at, at + len(part))
        many = np.maximum(ends - starts - size + 1, 0)
        if not many.any():
            continue
        owner = np.repeat(own, many)
        offset = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        if phases is not None:
            take = (offset % SYMBOL >= phases[0]) & (offset % SYMBOL < phases[1])
            owner, offset = owner[take], offset[take]
        found = rolling(np.frombuffer(b"".join(part), np.uint8), size)[starts[owner - at] + offset]
        out.append((_tagged(found, grams[owner], offset - before[owner]), owner, offset))
    if not out:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))  # type: ignore[return-value]


def _numbered(value: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of each value, occurrences by number); values of one block have neighbouring
    numbers, so suffixes to compare lie near each other."""
    # 22 bits for the block (at most COLLECTION / 2 + 1 grams of 3 * LENGTH places), the rest of the value
    order = np.argsort((block.astype(np.uint64) << np.uint64(42)) | (value >> np.uint64(22)))
    new = np.ones(len(value), dtype=bool)
    new[1:] = value[order][1:] != value[order][:-1]
    number = np.empty(len(value), dtype=np.int64)
    number[order] = np.cumsum(new) - 1
    return number, np.bincount(number)


def repeated_starts(segments: list[bytes], before: list[int], grams: list[int]) -> list[np.ndarray]:
    """Offsets in each segment of the 400-byte strings that another segment of its gram has at the
    same place. ``before``: bytes before the gram.

    Strings of different phases never match, so a large collection is built phase by phase, in
    memory that depends on ``COLLECTION`` alone."""
    rounds = min(SYMBOL, -(-len(segments) // (2 * COLLECTION)))
    cuts = [SYMBOL * i // rounds for i in range(rounds + 1)]
    found = [_repeated_in(segments, np.array(before), np.array(grams, dtype=np.int64), cuts[i:i + 2]) for i in range(rounds)]
    owner, start = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((start, owner))
    owner, start = owner[order], start[order]
    edges = np.searchsorted(owner, np.arange(len(segments) + 1))
    return [start[edges[i]:edges[i + 1]] for i in range(len(segments))]


def _repeated_in(segments: list[bytes], before: np.ndarray, grams: np.ndarray, phases: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """(segment, offset) of every repeated string of these phases.

    A symbol that occurs once can be in no match, so strings without ``LENGTH / SYMBOL`` other
    symbols in a row are left out."""
    per, none = LENGTH // SYMBOL, (np.zeros(0, np.int64), np.zeros(0, np.int64))
    value, owner, offset = _symbols_of(segments, before, grams, SYMBOL, (phases[0], phases[1]))
    if not len(value):
        return none
    number, often = _numbered(value, np.unique(grams, return_inverse=True)[1][owner] * (3 * LENGTH) + offset - before[owner] + LENGTH)
    wide, many = int(offset.max()) // SYMBOL + 1, phases[1] - phases[0]
    row, col = owner * many + offset % SYMBOL - phases[0], offset // SYMBOL
    symbols = np.full((len(segments) * many, wide), -1, dtype=np.int32)
    symbols[row, col] = number
    several = np.zeros(symbols.shape, dtype=bool)
    several[row, col] = often[number] > 1
    possible = np.zeros(len(symbols), dtype=bool)
    for c in range(wide - per + 1):
        possible |= several[:, c:c + per].all(axis=1)
    kept = np.flatnonzero(possible)
    if not len(kept):
        return none
    symbols = symbols[kept]
    string, column, prefix = insert_columns(symbols, (symbols >= 0).sum(axis=1))
    near = prefix >= per
    near[:-1] |= prefix[1:] >= per
    string = kept[string[near]]
    return string // many, column[near].astype(np.int64) * SYMBOL + string % many + phases[0]


def _spans(key: np.ndarray, start: np.ndarray) -> np.ndarray:
    """(key, a, z): byte spans [a, z) of every text covered by 400-byte strings at these starts."""
    key, spans = merged(np.stack([key, start, start + LENGTH], axis=1))
    return np.column_stack([key, spans])


def _anchor_rows(texts: DataFrame) -> DataFrame:
    """(gram, key, place): anchors of every text, once per task for equal texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            held, n = ([], [], []), 0
            for key, text in zip(batch.column("key").to_pylist(), batch.column("text"), strict=True):
                if key in seen:
                    continue
                seen.add(key)
                gram, place = anchors(np.frombuffer(text.as_buffer(), np.uint8))
                for out, x in zip(held, (gram.view(np.int64), np.full(len(gram), key, np.int64), place), strict=True):
                    out.append(x)
                n += len(gram)
            if n:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in held], ["gram", "key", "place"])

    return texts.mapInArrow(run, "gram long, key long, place long")


def _segment_rows(wanted: DataFrame) -> DataFrame:
    """(gram, segment hash, bytes before the gram, size, body, places): the places of one segment in a few thousand of a
    task are one row; body only once per task."""
    spot = pa.struct([("key", pa.int64()), ("a", pa.int64()), ("z", pa.int64())])
    names = ["gram", "segment", "before", "size", "body", "places"]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.list_(spot)]

    def made(held: dict[int, tuple]) -> pa.RecordBatch:
        cols = zip(*[(gram, segment, *rest) for segment, (gram, *rest) in held.items()], strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        sent: set[int] = set()
        held: dict[int, tuple] = {}
        many = 0
        for batch in batches:
            for i, key in enumerate(batch.column("key").to_pylist()):
                if key in seen:
                    continue
                seen.add(key)
                data = bytes(batch.column("text")[i].as_buffer())
                places, grams = (np.frombuffer(batch.column(c)[i].as_buffer(), np.int64).tolist() for c in ("places", "grams"))
                for place, gram in zip(places, grams, strict=True):
                    first = max(0, place - _BEFORE)
                    body = data[first:place + LENGTH]
                    digest = hashlib.blake2b(body + gram.to_bytes(8, "little", signed=True) + (place - first).to_bytes(4, "little"), digest_size=8)
                    segment = int.from_bytes(digest.digest(), "little", signed=True)
                    if segment not in held:
                        held[segment] = (gram, place - first, len(body), None if segment in sent else body, [])
                        sent.add(segment)
                    held[segment][-1].append({"key": key, "a": first, "z": first + len(body)})
                many += len(places)
                if many > 4_000:
                    yield made(held)
                    held, many = {}, 0
        if held:
            yield made(held)

    return (wanted.select("key", "text", "places", "grams")
            .mapInArrow(run, "gram long, segment long, before int, size int, body binary, places array<struct<key: long, a: long, z: long>>"))


def _by_collections(bodies: DataFrame, blocks: int) -> DataFrame:
    """(block, cells): repeated spans of the segments of grams with at most CROWD different ones, for one place of each."""

    def solve(held: list[tuple]) -> pa.RecordBatch:
        gram, _, before, body, key, first = zip(*held, strict=True)
        found = repeated_starts(body, before, gram)
        many = [len(x) for x in found]
        return packed(_spans(np.repeat(np.array(key, np.int64), many), np.concatenate(found) + np.repeat(np.array(first, np.int64), many)), blocks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # whole grams
        own: list[tuple] = []  # of the gram being read
        gram = None
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("gram", "segment", "before", "body", "key", "first")), strict=True):
                if row[0] != gram:
                    if len(own) > 1:
                        held += own
                    gram, own = row[0], []
                    if len(held) >= COLLECTION:
                        yield solve(held)
                        held = []
                if not own or own[-1][1] != row[1]:  # else sent by another task too
                    own.append(row)
        if len(own) > 1:
            held += own
        if held:
            yield solve(held)

    width = 2 * shuffle_width(bodies.sparkSession)
    return (bodies.repartition(width, "gram").sortWithinPartitions("gram", "segment")
            .select("gram", "segment", "before", "body", "key", "first").mapInArrow(run, "block int, cells binary"))


def _by_windows(strings: DataFrame, blocks: int) -> DataFrame:
    """(block, cells) of crowded grams: every 400-byte string by its hash, packed per block of hashes."""
    size = strings.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    parts = 1 << max(4, (32 * size // BLOCK).bit_length())  # 32 bytes for every byte of a body

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gram, segment, before, body, key, first = (batch.column(c).to_pylist() for c in ("gram", "segment", "before", "body", "key", "first"))
            value, owner, start = _symbols_of(body, np.array(before), np.array(gram, dtype=np.int64), LENGTH)
            segment, key, first = (np.array(x, dtype=np.int64)[owner] for x in (segment, key, first))
            yield packed(np.stack([value.view(np.int64), segment, key, first + start], axis=1), parts)

    def count(group: pa.Table) -> pa.Table:
        x = unpacked(group, 4)
        x = x[np.lexsort((x[:, 1], x[:, 0]))]
        x = x[np.r_[True, (x[1:, :2] != x[:-1, :2]).any(axis=1)]]  # a segment that several tasks sent counts once
        twice = np.zeros(len(x), dtype=bool)
        twice[1:] = x[1:, 0] == x[:-1, 0]
        twice[:-1] |= twice[1:]
        return pa.Table.from_batches([packed(_spans(x[twice, 2], x[twice, 3]), blocks)])

    return (strings.select("gram", "segment", "before", "body", "key", "first").mapInArrow(deal, "block int, cells binary")
            .groupBy("block").applyInArrow(count, "block int, cells binary"))


def with_keys(docs: DataFrame) -> DataFrame:
    """Adds ``key``: equal texts have equal keys."""
    text = F.coalesce("text", F.lit(""))
    return docs.withColumn("text", text).withColumn("key", F.xxhash64("text", F.octet_length("text")))


def repeated_spans(scratch: Scratch, texts: DataFrame) -> DataFrame:
    """(key, pieces): one row for every text with repeated bytes, its merged spans as packed int64
    pairs. Texts that occur twice are not listed. ``texts``: key, text, with equal texts repeated."""
    places, blocks = repeated_places(scratch, _anchor_rows(texts.where(F.octet_length("text") >= LENGTH)), "gram", ["place"], "anchors")
    wanted = by_text(dealt(places, blocks, "gram"), ["places", "grams"])
    rows = scratch.save(_segment_rows(texts.where(F.octet_length("text") >= LENGTH).join(wanted, "key")), "segments")
    scratch.drop("anchors")
    scratch.release()
    # a shorter segment holds no string of LENGTH bytes
    bodies = rows.where(f"octet_length(body) >= {LENGTH}").select("gram", "segment", "before", "body", F.expr("places[0].key AS key"), F.expr("places[0].a AS first"))
    blocks = blocks_for(rows.agg(F.sum(F.size("places"))).first()[0] or 0)
    crowded = scratch.save(rows.select("gram", "segment").distinct().groupBy("gram").agg(F.count("*").alias("n"))
                           .where(F.col("n") > CROWD).select("gram"), "crowded")
    many = not crowded.isEmpty()
    found = scratch.save(_by_collections(bodies.join(crowded, "gram", "left_anti") if many else bodies, blocks), "solved")
    scratch.release()
    if many:
        found = found.union(scratch.save(_by_windows(bodies.join(crowded, "gram", "left_semi"), blocks), "windows"))
    whole, _ = repeated_places(scratch, rows.where(f"size >= {LENGTH}").select("segment", "places"), "segment", [], "segment-places")
    return merged_by_text(found.union(dealt(whole, blocks)))


def merge_spans(pieces: list[bytes]) -> list[tuple[int, int]]:
    """Maximal runs of packed spans."""
    pairs = np.frombuffer(b"".join(pieces), np.int64).reshape(-1, 2)
    out: list[tuple[int, int]] = []
    for a, z in pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))].tolist():
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], z))
        else:
            out.append((a, z))
    return out


def kept_bytes(data: bytes, spans: list[tuple[int, int]]) -> bytes:
    out, at = [], 0
    for a, z in spans:
        out.append(data[at:a])
        at = z
    return b"".join([*out, data[at:]])


def kept_text(data: bytes, spans: list[tuple[int, int]]) -> str:
    """The text without its repeated spans; a character goes only if all its bytes do."""
    out, at = [], 0
    for a, z in spans:
        while a < z and data[a] & 0xC0 == 0x80:
            a += 1
        while z > a and z < len(data) and data[z] & 0xC0 == 0x80:
            z -= 1
        out.append(data[at:a])
        at = z
    return b"".join([*out, data[at:]]).decode()


def marks_of(docs: DataFrame, passages: bool = False) -> DataFrame:
    """(key, many, pieces) of every text of ``docs``: many, it occurs twice; pieces, the spans to remove of a text that
    occurs once, null for none. ``passages``: those of more than 50 words go too, however few bytes they have."""
    scratch = Scratch(docs.sparkSession, "suffix-dedup")
    keyed = with_keys(docs.select("text"))
    counts = keyed.groupBy("key").agg((F.count("*") > 1).alias("many"))
    spans = scratch.save(repeated_spans(scratch, keyed.select("key", "text"))
                         .join(counts.where("not many"), "key", "left_semi"), "spans")
    scratch.drop("segments", "solved", "windows", "crowded", "segment-places")
    if passages:
        scratch.release()
        more = repeated_words(scratch, keyed.select("key", "text")).join(counts.where("not many"), "key", "left_semi")
        spans = scratch.save(spans.union(more).groupBy("key").agg(F.flatten(F.collect_list("pieces")).alias("pieces")), "all-spans")
        scratch.drop("spans", "word-windows")
    scratch.release()
    return counts.join(spans, "key", "left")


def _whole(passages: bool) -> F.Column:
    """A text that occurs twice is long enough to go whole."""
    long = F.octet_length("text") >= LENGTH
    return long | (F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")) >= WORDS) if passages else long


def without_repeats(docs: DataFrame, passages: bool = False) -> DataFrame:
    """The documents without repeated characters: text and, where it is a column, n_chars are new.
    Documents of which nothing is left stay, with an empty text. ``passages``: passages of more than
    50 words that occur elsewhere go too. Texts meet their spans in one shuffle."""
    key, many, pieces, changed = (fresh(n, docs.columns) for n in ("suffix_key", "suffix_many", "suffix_pieces", "suffix_changed"))
    marks = marks_of(docs, passages).toDF(key, many, pieces)
    text = F.coalesce("text", F.lit(""))
    joined = (docs.withColumn(key, F.xxhash64(text, F.octet_length(text))).join(marks, key)
              .withColumn(changed, F.coalesce(F.col(many) & _whole(passages), F.lit(False)) | F.col(pieces).isNotNull()).drop(key))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for i in np.flatnonzero(batch.column(changed).to_numpy(zero_copy_only=False)):
                found = batch.column(pieces)[i].as_py()
                texts[i] = "" if found is None else kept_text(texts[i].encode(), merge_spans(found))
            yield batch.set_column(batch.schema.get_field_index("text"), "text", pa.array(texts, pa.string()))

    new = joined.mapInArrow(run, joined.schema)
    out = {}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out["n_chars"] = F.when(F.col(changed), F.length("text").cast(kind)).otherwise(F.col("n_chars"))
    return new.select(*[out.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, last, the text that is left (without characters
    whose bytes all go) of every row of ``docs`` (doc_id, text)."""
    rows = with_keys(docs.select("doc_id", "text")).join(marks_of(docs), "key").select("doc_id", "text", "many", "pieces")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for i, (text, many, pieces) in enumerate(zip(*(batch.column(c) for c in ("text", "many", "pieces")), strict=True)):
                data = bytes(text.as_buffer())
                found = merge_spans(pieces.as_py()) if pieces.is_valid else [(0, len(data))] if many.as_py() and len(data) >= LENGTH else []
                kept = kept_bytes(data, found)
                out.append((batch.column("doc_id")[i].as_py(), len(data), len(data) - len(kept), len(found), hashlib.sha256(kept).hexdigest(),
                            kept_text(data, found)))
            kinds = [pa.int64()] * 4 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*out, strict=True)) or [()] * 6, kinds, strict=True)],
                                             ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "text"])

    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, text string")


def op5_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))
