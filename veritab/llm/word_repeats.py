"""Passages of more than 50 words that occur elsewhere, whatever their length in bytes.

A word is a run of bytes outside ``[\\x20\\x09-\\x0D]``, compared exactly; the space between two words
is not compared. A passage is repeated where a window of ``WORDS`` words occurs at another place of
any text. As in ``suffix_dedup`` the windows are first cut down without loss:

1. Anchors. In every window the gram of ``GRAM`` words with the smallest hash (leftmost on ties) is
   its anchor; equal windows have equal anchors. Only grams at two places or more matter.
2. The windows of those anchors are compared by 64-bit hashes. A window counts as repeated if the
   smallest and the largest of its places differ; places are packed (``places``), so no task holds all
   places of a window that very many texts share.

Equal texts are read once here; the caller removes them whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .places import by_text, dealt, merged_by_text, repeated_places
from .shared import Scratch
from .words import PIECE, _tables, mix

#: Words of a repeated passage and of an anchor; the shortest passage in bytes.
WORDS, GRAM = 51, 26
BYTES = 2 * WORDS - 1
#: Words read at once; blocks overlap by WORDS - 1.
READ = 1 << 19


def _pieces(data: np.ndarray) -> Iterator[tuple[int, int]]:
    """Byte ranges of about PIECE bytes that end at a space or at the end of the text."""
    space, at = _tables()["space"], 0
    while at < len(data):
        end = min(at + PIECE, len(data))
        while end < len(data):
            found = np.flatnonzero(space[data[end:end + PIECE]])
            if len(found):
                end += int(found[0])
                break
            end = min(end + PIECE, len(data))
        yield at, end
        at = end


def words_of(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first byte, end) of every word of a text."""
    t, out = _tables(), []
    values = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))
    for at, end in _pieces(data):
        part = data[at:end]
        solid = np.r_[False, ~t["space"][part], False]
        starts, ends = np.flatnonzero(solid[1:] & ~solid[:-1]), np.flatnonzero(solid[:-1] & ~solid[1:])
        if not len(starts):
            continue
        sizes = ends - starts
        inside = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        terms = values[part[solid[1:-1]]] * t["power"][inside % PIECE]
        out.append((mix(np.add.reduceat(terms, np.cumsum(sizes) - sizes)), starts + at, ends + at))
    if not out:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))  # type: ignore[return-value]


def _rolling(words: np.ndarray, size: int) -> np.ndarray:
    """64-bit hash of every run of ``size`` words of a block."""
    t = _tables()
    sums = np.zeros(len(words) + 1, dtype=np.uint64)
    np.cumsum(words * t["power"][:len(words)], out=sums[1:])
    return mix((sums[size:] - sums[:-size]) * t["inverse"][:len(words) - size + 1])


def windows(words: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first word, gram hashes, anchor of every window, window hashes) per block; anchors are
    counted from the first word of the block."""
    low = np.uint64((1 << 20) - 1)
    for at in range(0, max(len(words) - WORDS + 1, 0), READ):
        part = words[at:at + READ + WORDS - 1]
        grams = _rolling(part, GRAM)
        keys = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
        least = np.lib.stride_tricks.sliding_window_view(keys, WORDS - GRAM + 1).min(axis=1)
        yield at, grams, (least & low).astype(np.int64), _rolling(part, WORDS)


def _anchor_rows(texts: DataFrame) -> DataFrame:
    """(gram, key, place): anchors of every text, once per task for equal texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            held: list[tuple] = []
            for key, text in zip(batch.column("key").to_pylist(), batch.column("text"), strict=True):
                if key in seen:
                    continue
                seen.add(key)
                words, _, _ = words_of(np.frombuffer(text.as_buffer(), np.uint8))
                for at, grams, anchor, _ in windows(words):
                    place = np.unique(anchor)
                    held.append((grams[place].view(np.int64), np.full(len(place), key, np.int64), place + at))
            if held:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*held, strict=True)], ["gram", "key", "place"])

    return texts.mapInArrow(run, "gram long, key long, place long")


def _window_rows(wanted: DataFrame) -> DataFrame:
    """(value, key, a, z): hash and bytes [a, z) of the windows whose anchors are wanted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for i, key in enumerate(batch.column("key").to_pylist()):
                if key in seen:
                    continue
                seen.add(key)
                places = np.frombuffer(batch.column("places")[i].as_buffer(), np.int64)
                words, starts, ends = words_of(np.frombuffer(batch.column("text")[i].as_buffer(), np.uint8))
                for at, _, anchor, value in windows(words):
                    found = np.flatnonzero(np.isin(anchor + at, places))
                    if len(found):
                        cols = (value[found].view(np.int64), np.full(len(found), key, np.int64), starts[found + at], ends[found + at + WORDS - 1])
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["value", "key", "a", "z"])

    return wanted.select("key", "text", "places").mapInArrow(run, "value long, key long, a long, z long")


def repeated_words(scratch: Scratch, texts: DataFrame) -> DataFrame:
    """(key, pieces) as ``suffix_dedup.repeated_spans`` gives them, of passages of ``WORDS`` words or
    more. ``texts``: key, text, with equal texts repeated."""
    texts = texts.where(F.octet_length("text") >= BYTES)
    places, blocks = repeated_places(scratch, _anchor_rows(texts), "gram", ["place"], "word-anchors")
    wanted = by_text(dealt(places, blocks), ["places"])
    rows, blocks = repeated_places(scratch, _window_rows(texts.join(wanted, "key")), "value", ["a", "z"], "word-windows")
    scratch.drop("word-anchors")
    scratch.release()
    return merged_by_text(dealt(rows, blocks))
