"""Operator 7: Merkle tree fingerprints over sections, paragraphs and sentences.

A text is cut without loss: sections end at blank lines (or after ``SECTION`` paragraphs),
paragraphs at line ends, leaves at sentence ends (or after ``LEAF`` characters within a sentence).
Every node hashes its children, so two texts are equal where the roots are, and a comparison only
descends into branches that differ. A fingerprint is one string: the 128-bit root, then the short
hash of every section with those of its leaves, paragraph by paragraph. Likeness is the Dice share
of leaves that two trees have in common (equal roots: 1); ``differing_leaves`` locates an edit.

Fingerprints are made per row, map-side. The query also compares each document with an edited
form and with its neighbour in descending order of doc_id: documents are dealt into ranges of
doc_id at quantiles, and the last row of a range meets the first of the next lower one, which is
sent there too; so texts are shuffled once and no task sees all rows. Of rows with the same
doc_id the smaller text comes first; a null doc_id counts as the smallest.

Null texts are empty; the empty text has a fingerprint of its own; a table with one row is its own
neighbour; an empty table gives no rows; only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import shuffle_width, table

#: Most paragraphs of a section and characters of a leaf; hexadecimal digits of a short hash.
SECTION, LEAF, SHORT = 16, 120, 8

_SENTENCE = re.compile(r"(?<=[.!?])(?=\s)")
_LOWEST = -(1 << 63)


def _node(kind: bytes, parts: list[bytes]) -> bytes:
    return hashlib.blake2b(kind + b"".join(parts), digest_size=16).digest()


def _leaves(paragraph: str) -> list[str]:
    out = []
    for sentence in _SENTENCE.split(paragraph):
        if len(sentence) <= LEAF:
            out.append(sentence)
        else:
            out.extend(sentence[i:i + LEAF] for i in range(0, len(sentence), LEAF))
    return out


def _sections(text: str) -> Iterator[list[str]]:
    held: list[str] = []
    for paragraph in text.split("\n"):
        held.append(paragraph)
        if len(held) == SECTION or not paragraph.strip():
            yield held
            held = []
    if held:
        yield held


def fingerprint(text: str | None) -> str:
    """root;section:leaf,leaf/leaf;section:... with ``/`` between paragraphs."""
    sections, shown = [], []
    for section in _sections(text or ""):
        paragraphs, leaf_texts = [], []
        for paragraph in section:
            digests = [_node(b"L", [x.encode("utf-8", "surrogatepass")]) for x in _leaves(paragraph)]
            paragraphs.append(_node(b"P", digests))
            leaf_texts.append(",".join(d.hex()[:SHORT] for d in digests))
        sections.append(_node(b"S", paragraphs))
        shown.append(f"{sections[-1].hex()[:SHORT]}:{'/'.join(leaf_texts)}")
    return ";".join([_node(b"R", sections).hex(), *shown])


def likeness(a: str, b: str) -> float:
    """Dice share of common leaves of two fingerprints; 1 where the roots are equal."""
    (root_a, _, rest_a), (root_b, _, rest_b) = a.partition(";"), b.partition(";")
    if root_a == root_b:
        return 1.0
    sides = []
    for rest in (rest_a, rest_b):
        sides.append(Counter(x for s in rest.split(";") for x in re.split("[,/]", s.partition(":")[2])))
    common = sum((sides[0] & sides[1]).values())
    return 2.0 * common / (sides[0].total() + sides[1].total())


def differing_leaves(a: str, b: str) -> list[tuple[int, int, int]]:
    """(section, paragraph, leaf) of a's leaves that b's tree has not at a branch of equal hash."""
    if a.partition(";")[0] == b.partition(";")[0]:
        return []
    other = b.split(";")[1:]
    equal = {s.partition(":")[0] for s in other}
    leaves = Counter(x for s in other for x in re.split("[,/]", s.partition(":")[2]))
    out = []
    for i, section in enumerate(a.split(";")[1:]):
        top, _, body = section.partition(":")
        if top in equal:
            continue
        for j, paragraph in enumerate(body.split("/")):
            for k, leaf in enumerate(paragraph.split(",")):
                if leaves[leaf]:
                    leaves[leaf] -= 1
                else:
                    out.append((i, j, k))
    return out


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint of every row of ``docs`` (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = pa.array([fingerprint(x.as_py()) for x in batch.column("text")], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), prints], ["doc_id", "fingerprint"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, fingerprint string")


def _ranged(docs: DataFrame) -> tuple[DataFrame, int]:
    """(bucket, guest, rank, doc_id, text): ranges of doc_id, each with the first row of the next
    lower range as its guest (the lowest has the first row of all)."""
    ranges = 2 * shuffle_width(docs.sparkSession)
    keyed = docs.select("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(_LOWEST)).alias("rank"),
                        F.coalesce("text", F.lit("")).alias("text"))
    steps = [i / ranges for i in range(1, ranges)]
    cuts = np.array(sorted(set(keyed.agg(F.percentile_approx("rank", steps, 100 * ranges)).first()[0] or [])), np.int64)

    @F.pandas_udf("int")
    def bucket_of(rank: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, rank.to_numpy(), "right").astype(np.int32))

    tops = {r["bucket"]: r["top"] for r in  # one row per range
            keyed.select("rank", bucket_of("rank").alias("bucket")).groupBy("bucket").agg(F.max("rank").alias("top")).collect()}
    order = sorted(tops)
    host_of = {tops[low]: high for low, high in zip(order, order[1:] + order[:1], strict=True)}

    @F.pandas_udf("int")
    def host(rank: pd.Series) -> pd.Series:
        return rank.map(host_of).astype("Int32")

    own = F.struct(bucket_of("rank").alias("bucket"), F.lit(0).alias("guest"))
    guest = F.struct(host("rank").alias("bucket"), F.lit(1).alias("guest"))
    both = keyed.withColumn("place", F.explode(F.array(own, guest))).where("place.bucket is not null")
    return both.select("place.bucket", "place.guest", "rank", "doc_id", "text"), ranges


def edited_neighbours(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    placed, ranges = _ranged(docs)
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the row before: bucket, doc_id, text, fingerprint
        for batch in batches:
            rows = []
            for bucket, guest, doc_id, text in zip(*(batch.column(c) for c in ("bucket", "guest", "doc_id", "text")), strict=True):
                bucket, guest, doc_id, text = bucket.as_py(), guest.as_py(), doc_id.as_py(), text.as_py()
                same = held is not None and held[0] == bucket
                if not same and guest:
                    continue  # a further guest of the same doc_id
                print_ = fingerprint(text)
                if same:
                    _, before_id, before, before_print = held
                    k = len(before) // 3
                    edited = before[:len(before) - k] + text[:k]
                    edited_print = fingerprint(edited)
                    rows.append((before_id, len(before), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
                                 before_print, edited_print, likeness(before_print, edited_print), likeness(before_print, print_)))
                held = None if guest else (bucket, doc_id, text, print_)
            cols = list(zip(*rows, strict=True)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names)

    return (placed.repartition(ranges, "bucket").sortWithinPartitions("bucket", "guest", F.desc("rank"), "text")
            .select("bucket", "guest", "doc_id", "text")
            .mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                             "edited_fingerprint string, near_edited double, near_next double"))


def op7_merkle_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_neighbours(table(spark, sf_dir, "documents"))
