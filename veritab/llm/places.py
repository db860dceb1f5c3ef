"""Places of values in texts, packed in arrays: a value that very many texts share makes no row for every place, and no
task or group holds all of its places.

A place is the key of a text and further whole numbers. The places of a value lie in ``SALTS`` parts by their key, one
array each, until they are dealt to blocks of texts.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Scratch

#: Parts of one value's places; bytes of a block of texts.
SALTS, BLOCK = 64, 4 << 20


def repeated_places(scratch: Scratch, rows: DataFrame, value: str, spot: Sequence[str], name: str) -> tuple[DataFrame, int]:
    """(value, places) of the values that lie at two places or more, each part of their places as one array of structs of
    ``key`` and ``spot``; and the number of blocks for them. ``rows``: a row per place, or some in an array ``places`` of
    such structs; repeated ones count once."""
    key = F.col("key") if spot else F.col("places")[0]["key"]
    own = F.collect_list(F.struct("key", *spot)) if spot else F.flatten(F.collect_list("places"))
    parts = scratch.save(rows.groupBy(value, F.pmod(key, F.lit(SALTS)).alias("salt")).agg(own.alias("places")), name)
    ends = parts.select(value, F.array_min("places").alias("a"), F.array_max("places").alias("z"))
    twice = ends.groupBy(value).agg(F.min("a").alias("a"), F.max("z").alias("z")).where("a <> z").select(value)
    twice = parts.select(value, "salt").join(twice, value)
    many = parts.agg(F.sum(F.size("places"))).first()[0] or 0
    return parts.join(twice, [value, "salt"]).select(value, "places"), blocks_for(many)


def blocks_for(many: int) -> int:
    """Blocks of texts for this many places of three numbers."""
    return 1 << max(4, (24 * many // BLOCK).bit_length())


def packed(cells: np.ndarray, blocks: int) -> pa.RecordBatch:
    """(block, cells): rows of int64 in one binary per block, which the upper bits of their first number name."""
    cells = np.ascontiguousarray(cells, dtype=np.int64)
    block = np.ascontiguousarray(cells[:, 0]).view(np.uint64) >> np.uint64(65 - blocks.bit_length())
    order = np.argsort(block, kind="stable")
    found, first = np.unique(block[order], return_index=True)
    parts = [cells[x].tobytes() for x in np.split(order, first[1:])] if len(found) else []
    return pa.RecordBatch.from_arrays([pa.array(found.astype(np.int32)), pa.array(parts, pa.binary())], ["block", "cells"])


def unpacked(group: pa.Table, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(group.column("cells").to_pylist()), np.int64).reshape(-1, width)


def dealt(places: DataFrame, blocks: int, value: str | None = None) -> DataFrame:
    """(block, cells): the places of (value, places) dealt to blocks of texts; ``value`` is the last number where it is named."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("places")
            spots = lists.flatten()
            columns = [spots.field(i).to_numpy(zero_copy_only=False) for i in range(spots.type.num_fields)]
            if value:
                columns.append(np.repeat(batch.column(value).to_numpy(), lists.value_lengths().to_numpy()))
            yield packed(np.stack(columns, axis=1), blocks)

    return places.select(*[value] * bool(value), "places").mapInArrow(run, "block int, cells binary")


def by_text(cells: DataFrame, names: Sequence[str]) -> DataFrame:
    """(key, names...): the different cells of every text by their second number, each other number packed as int64."""

    def run(group: pa.Table) -> pa.Table:
        x = unpacked(group, 1 + len(names))
        x = x[np.lexsort((x[:, 1], x[:, 0]))]
        x = x[np.r_[True, (x[1:, :2] != x[:-1, :2]).any(axis=1)]] if len(x) else x
        first = np.flatnonzero(np.r_[True, x[1:, 0] != x[:-1, 0]]) if len(x) else np.zeros(0, np.int64)
        parts = np.split(x, first[1:]) if len(x) else []
        return pa.table({"key": x[first, 0]} | {n: pa.array([p[:, i].tobytes() for p in parts], pa.binary()) for i, n in enumerate(names, 1)})

    return cells.groupBy("block").applyInArrow(run, "key long, " + ", ".join(f"{n} binary" for n in names))


def merged(cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(key, start and end) of the maximal runs of spans (key, start, end) of each key, in ascending order."""
    if not len(cells):
        return np.zeros(0, np.int64), np.zeros((0, 2), np.int64)
    key, a, z = cells[np.lexsort((cells[:, 1], cells[:, 0]))].T
    fresh = np.r_[True, key[1:] != key[:-1]]
    lift = (np.cumsum(fresh) - 1) * (int(z.max()) + 1)  # ends of later keys are larger
    reach = np.maximum.accumulate(z + lift) - lift
    first = np.flatnonzero(fresh | np.r_[True, a[1:] > reach[:-1]])
    return key[first], np.stack([a[first], reach[np.r_[first[1:], len(key)] - 1]], axis=1)


def merged_by_text(cells: DataFrame) -> DataFrame:
    """(key, pieces): the merged spans of every text of (block, cells) as one packed piece."""

    def run(group: pa.Table) -> pa.Table:
        key, spans = merged(unpacked(group, 3))
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
        pieces = [[x.tobytes()] for x in np.split(spans, first[1:])] if len(key) else []
        return pa.table({"key": key[first], "pieces": pa.array(pieces, pa.list_(pa.binary()))})

    return cells.groupBy("block").applyInArrow(run, "key long, pieces array<binary>")
