"""Operator 8: size-partitioned MinHash containment search for benchmark items in documents.

An item is contained where at least 75 percent of its distinct word shingles are in the document's
set. Resemblance says little when an item is short and a document long, so items are partitioned
by the size of their sets, and an item of n shingles is sketched by its n - ceil(0.75 n) + 1
smallest hash values: a document that contains the item holds at least one of them, so a match
on any sketch value finds every contained item (bands of a fixed number of independent hash
functions would miss some). A document skips the partitions whose items need more shingles than
it has. Every match is verified by exact containment on the whole sets.

Items are read in blocks of bounded size; each block is broadcast and searched by one pass over the
documents, which need no shuffle. Null or empty texts and items have no shingles and match
nothing; repeated rows give repeated results; a table without rows gives none.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .shared import table
from .words import NEAR, SHINGLE, mix, pieces_of_rows, shingle_hashes, shingle_sets, text_buffers, word_hashes

#: Bytes of item text in one broadcast block; bits of the table that screens shingles.
BLOCK_BYTES, SCREEN_BITS = 8 << 20, 20

_SCHEMA = "doc_id long, item_id long, n_item_shingles int, n_shared int, containment double"


def _min_order(shingles: np.ndarray) -> np.ndarray:
    """The hash values whose smallest make the sketch."""
    return mix(shingles ^ np.uint64(0x2545F4914F6CDD1D))


class ItemIndex:
    """Sketches of a block of items, partitioned by set size (powers of two)."""

    def __init__(self, ids: list, texts: list, near: int = NEAR, size: int = SHINGLE):
        self.near, self.size = near, size
        found = [(ids[i], s) for i, s in shingle_sets(pa.array(texts, pa.string()), size) if len(s)]
        self.ids, self.sets = [i for i, _ in found], [s for _, s in found]
        self.need = np.array([-(-near * len(s) // 100) for s in self.sets], dtype=np.int64)
        by_class: dict[int, list[int]] = {}
        for k, s in enumerate(self.sets):
            by_class.setdefault(len(s).bit_length(), []).append(k)
        self.parts = []  # (fewest shingles that any item needs, sketch values, their items)
        for group in by_class.values():
            values, owners = [], []
            for k in group:
                s = self.sets[k]
                order = np.argsort(_min_order(s))[:len(s) - int(self.need[k]) + 1]
                values.append(s[order])
                owners.append(np.full(len(order), k))
            value, owner = np.concatenate(values), np.concatenate(owners)
            order = np.argsort(value, kind="stable")
            self.parts.append((int(self.need[group].min()), value[order], owner[order]))
        self.screen = np.zeros(1 << SCREEN_BITS, dtype=bool)
        for _, value, _ in self.parts:
            self.screen[value >> np.uint64(64 - SCREEN_BITS)] = True

    @classmethod
    def of(cls, state: dict) -> ItemIndex:
        """From its broadcast attributes (executors need not have this package)."""
        index = cls.__new__(cls)
        index.__dict__.update(state)
        return index

    def search(self, shingles: np.ndarray, hits: np.ndarray) -> list[tuple[int, int]]:
        """(item number, shared shingles) of the contained items. ``hits``: the document's
        screened shingles; ``shingles``: all of them, not yet distinct."""
        candidates: set[int] = set()
        for need, value, owner in self.parts:
            if len(shingles) < need:
                continue
            a, z = np.searchsorted(value, hits, "left"), np.searchsorted(value, hits, "right")
            for i, j in zip(a[z > a], z[z > a], strict=True):
                candidates.update(owner[i:j].tolist())
        if not candidates:
            return []
        whole = np.unique(shingles)
        shared = {k: len(np.intersect1d(whole, self.sets[k], assume_unique=True)) for k in candidates}
        return sorted((k, n) for k, n in shared.items() if n >= self.need[k])


def _blocks(items: DataFrame, block_bytes: int) -> Iterator[tuple[list, list]]:
    """Items in blocks of bounded size; the driver holds one block at a time."""
    ids, texts, held = [], [], 0
    for row in items.select("item_id", "text").toLocalIterator():
        text = row["text"] or ""
        ids.append(row["item_id"])
        texts.append(text)
        held += len(text) * 4
        if held >= block_bytes:
            yield ids, texts
            ids, texts, held = [], [], 0
    yield ids, texts


def _found_in(index: ItemIndex, column: pa.Array) -> Iterator[tuple[int, int, int]]:
    """(row, item number, shared shingles) of every contained item."""
    body, offsets = text_buffers(column)
    for a, b in pieces_of_rows(offsets):
        words, counts = word_hashes(body, offsets[a:b + 1])
        hashes, owner = shingle_hashes(words, counts, index.size)
        hit = np.flatnonzero(index.screen[hashes >> np.uint64(64 - SCREEN_BITS)])
        for r in np.unique(owner[hit]):
            own = hashes[np.searchsorted(owner, r):np.searchsorted(owner, r, "right")]
            for k, n in index.search(own, np.unique(hashes[hit[owner[hit] == r]])):
                yield a + int(r), k, n


def contained_items(docs: DataFrame, items: DataFrame, near: int = NEAR, size: int = SHINGLE,
                    block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, item_id, n_item_shingles, n_shared, containment of every contained item."""
    context = docs.sparkSession.sparkContext

    def pass_over(ids: list, texts: list) -> DataFrame:
        shared = context.broadcast(vars(ItemIndex(ids, texts, near, size)))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = ItemIndex.of(shared.value)
            for batch in batches:
                doc_ids = batch.column("doc_id").to_pylist()
                rows = [(doc_ids[r], index.ids[k], len(index.sets[k]), n, n / len(index.sets[k]))
                        for r, k, n in _found_in(index, batch.column("text"))]
                cols = list(zip(*rows, strict=True)) or [()] * 5
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.float64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                                                 ["doc_id", "item_id", "n_item_shingles", "n_shared", "containment"])

        return docs.select("doc_id", "text").mapInArrow(run, _SCHEMA)

    return reduce(DataFrame.union, [pass_over(*block) for block in _blocks(items, block_bytes)])


def without_items(docs: DataFrame, items: DataFrame, near: int = NEAR, size: int = SHINGLE,
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs`` whose text contains no item, with all their columns."""
    context = docs.sparkSession.sparkContext
    for ids, texts in _blocks(items, block_bytes):
        shared = context.broadcast(vars(ItemIndex(ids, texts, near, size)))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:  # noqa: ANN001
            index = ItemIndex.of(shared.value)
            for batch in batches:
                clean = np.ones(len(batch), dtype=bool)
                clean[[r for r, _, _ in _found_in(index, batch.column("text"))]] = False
                yield batch.filter(pa.array(clean))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every pair of a document and a benchmark item that it contains."""
    return contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _sets_sql(name: str, key: str) -> str:
    return f"""
{name}_words AS (
  SELECT {key}, list_filter(regexp_split_to_array(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
  FROM {name}),
{name}_sets AS (
  SELECT {key}, unnest(CASE WHEN w IS NULL OR len(w) = 0 THEN []
    WHEN len(w) < {SHINGLE} THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - {SHINGLE} + 2), lambda i: array_to_string(w[i:i + {SHINGLE} - 1], ' '))) END) AS g
  FROM {name}_words)"""


OP8_SQL = f"""
WITH {_sets_sql('documents', 'doc_id')}, {_sets_sql('benchmark', 'item_id')},
sizes AS (SELECT item_id, count(*) AS n FROM benchmark_sets GROUP BY 1),
shared AS (SELECT doc_id, item_id, count(*) AS o FROM documents_sets JOIN benchmark_sets USING (g) GROUP BY 1, 2)
SELECT doc_id, item_id, CAST(n AS INTEGER) AS n_item_shingles, CAST(o AS INTEGER) AS n_shared, o / n AS containment
FROM shared JOIN sizes USING (item_id) WHERE 100 * o >= {NEAR} * n
"""
