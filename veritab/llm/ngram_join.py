"""Operator 1: n-gram Jaccard self-join with adaptive multi-match prefixes.

Tokens are word shingles; two documents link when 100 * |x & y| >= 75 * |x | y|.

1. Documents with the same shingle set are one class (64-bit key of the set).
2. Every shingle of every class is dealt out by hash in packed arrays, which gives exact document
   frequencies over the whole corpus. A shingle of one class only can link nothing: it counts
   towards the class's prefix (it is the rarest there is) and is not sent on.
3. Per class, the other shingles are ordered by (frequency, hash). Similar classes x, y share
   at least ``l`` tokens of their prefixes of length n - ceil(0.75 n) + l, for every l; with
   different lengths they share min(lx, ly). Each class picks the l whose estimated candidates
   (sum of frequencies over the prefix, divided by l) cost least.
4. Hubs first: in each prefix token's list all members meet the most central one (with the fewest
   tokens of its own). Of the hubs that a class shares most tokens with, the one that most classes
   meet is verified. The links give components; only members of different components are
   paired from here on, so no link that could join two of them is lost.
5. Members x, y of one hub, h its tokens that others have too, D = h - x and A = x - h: |x & y| is
   |h| - |Dx | Dy| + |Ax & Ay|, so they need k = |Dx| + |Dy| - |h| + overlap common differences from h.
   They are joined by the prefixes of their differences, of which near copies have few and
   hardly any in common, so a large group of near copies does not meet pair by pair. Pairs with
   k <= 0 are similar, and then so is each of them to the member of least |D| + overlap share of
   its size, which is paired with all members of its hub.
6. Members of different hubs are joined by their prefix tokens. A token counts for a pair where
   what follows it in both orders, and l, still allow the overlap that their sizes need.
7. Pairs that share enough are verified on the whole sets.

Packed tokens keep their block number and 40 more bits of the 64-bit shingle hash (44 to 49 bits at usual
widths), on which links are verified; two shingles of one pair of texts that fall together can change a link only
where the similarity is exactly at the limit. Null and empty texts have no shingles and link with
nothing; repeated rows are members of the same class; a null doc_id takes no part in the minimum; an empty
table gives no rows. Only doc_id and text are read, so other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import Scratch, components, fresh, shuffle_width, table
from .words import NEAR, SHINGLE, mix, shingle_sets

#: Shingles packed before rows are sent on; largest l that a class may choose.
FLUSH, LONGEST = 1 << 20, 16


def _key(shingles: np.ndarray) -> int:
    """64-bit key of a set (order does not matter as the set is sorted and distinct)."""
    total = int(np.add.reduce(mix(shingles ^ np.uint64(0x5851F42D4C957F2D)), dtype=np.uint64))
    return int(mix(np.array([total ^ len(shingles)], dtype=np.uint64)).view(np.int64)[0])


def members(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(doc_id, key, n) of every row; key is null without shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys: list[int | None] = [None] * len(batch)
            counts = np.zeros(len(batch), dtype=np.int64)
            for i, s in shingle_sets(batch.column("text"), size):
                counts[i] = len(s)
                keys[i] = _key(s) if len(s) else None
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(keys, pa.int64()), pa.array(counts)],
                                             ["doc_id", "key", "n"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, key long, n long")


def _packed(docs: DataFrame, blocks: int, size: int) -> DataFrame:
    """Shingles of all classes, packed per block of the hash space: owners index ``keys``."""
    shift = np.uint64(64 - (blocks.bit_length() - 1))

    def rows(sets: list[np.ndarray], keys: list[int]) -> pa.RecordBatch:
        tokens = np.concatenate(sets)
        owners = np.repeat(np.arange(len(sets), dtype=np.uint32), [len(s) for s in sets])
        order = np.argsort(tokens, kind="stable")
        tokens, owners = tokens[order], owners[order]
        edges = np.searchsorted(tokens >> shift, np.arange(blocks + 1))
        all_keys = np.array(keys, dtype=np.int64)
        sizes = np.array([len(s) for s in sets], dtype=np.int32)
        out: dict[str, list] = {"block": [], "keys": [], "sizes": [], "low": [], "high": [], "owner": []}
        for b in range(blocks):
            a, z = edges[b], edges[b + 1]
            if a == z:
                continue
            used, local = np.unique(owners[a:z], return_inverse=True)
            part = tokens[a:z]
            out["block"].append(b)
            out["keys"].append(all_keys[used].tobytes())
            out["sizes"].append(sizes[used].tobytes())
            out["low"].append(part.astype(np.uint32).tobytes())
            out["high"].append((part >> np.uint64(32)).astype(np.uint8).tobytes())
            out["owner"].append(local.astype(np.uint16 if len(used) <= 65536 else np.uint32).tobytes())
        return pa.RecordBatch.from_arrays([pa.array(out["block"], pa.int32())]
                                          + [pa.array(out[c], pa.binary()) for c in list(out)[1:]], list(out))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        sets: list[np.ndarray] = []
        keys: list[int] = []
        held = 0
        for batch in batches:
            for _, s in shingle_sets(batch.column("text"), size):
                if not len(s) or (k := _key(s)) in seen:
                    continue
                seen.add(k)
                sets.append(s)
                keys.append(k)
                held += len(s)
                if held >= FLUSH:
                    yield rows(sets, keys)
                    sets, keys, held = [], [], 0
        if sets:
            yield rows(sets, keys)

    return docs.select("text").mapInArrow(
        run, "block int, keys binary, sizes binary, low binary, high binary, owner binary")


def _joined(table: pa.Table, name: str, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(x.as_py() for x in table.column(name)), dtype=kind)


def _shared_tokens(packed: DataFrame, blocks: int, parts: int) -> DataFrame:
    """Tokens of two classes or more, regrouped by class: packed per ``part`` of the key space."""

    def run(block: pa.Table) -> pa.Table:
        if not block.num_rows:
            return pa.table({"part": pa.array([], pa.int32()), **{c: pa.array([], pa.binary()) for c in ("keys", "sizes", "tokens", "df")}})
        b = block.column("block")[0].as_py()
        keys, sizes, tokens = [], [], []
        for i in range(block.num_rows):
            row = {c: block.column(c)[i].as_py() for c in ("keys", "sizes", "low", "high", "owner")}
            k = np.frombuffer(row["keys"], np.int64)
            owner = np.frombuffer(row["owner"], np.uint16 if len(k) <= 65536 else np.uint32)
            low = np.frombuffer(row["low"], np.uint32)
            keys.append(k[owner])
            sizes.append(np.frombuffer(row["sizes"], np.int32)[owner])
            tokens.append(low.astype(np.uint64) | (np.frombuffer(row["high"], np.uint8).astype(np.uint64) << np.uint64(32)))
        key, n, token = np.concatenate(keys), np.concatenate(sizes), np.concatenate(tokens)
        order = np.argsort(token, kind="stable")
        token, key, n = token[order], key[order], n[order]
        again = np.zeros(len(token), dtype=bool)
        again[1:] = token[1:] == token[:-1]
        group = again.copy()
        group[:-1] |= again[1:]
        token, key, n = token[group], key[group], n[group]
        order = np.lexsort((key, token))  # a class that several tasks sent counts once
        token, key, n = token[order], key[order], n[order]
        fresh = np.ones(len(token), dtype=bool)
        fresh[1:] = (token[1:] != token[:-1]) | (key[1:] != key[:-1])
        token, key, n = token[fresh], key[fresh], n[fresh]
        _, inverse, df = np.unique(token, return_inverse=True, return_counts=True)
        df = df[inverse] if len(token) else np.zeros(0, np.int64)
        keep = df >= 2
        token, key, n, df = token[keep], key[keep], n[keep], df[keep]
        token = token | np.uint64(b << 40)
        part = (mix(key.view(np.uint64)) % np.uint64(parts)).astype(np.int32)
        order = np.argsort(part, kind="stable")
        token, key, n, df, part = token[order], key[order], n[order], df[order], part[order]
        edges = np.searchsorted(part, np.arange(parts + 1))
        cuts = [(p, edges[p], edges[p + 1]) for p in range(parts) if edges[p] < edges[p + 1]]
        return pa.table({
            "part": pa.array([p for p, _, _ in cuts], pa.int32()),
            "keys": pa.array([key[a:z].tobytes() for _, a, z in cuts], pa.binary()),
            "sizes": pa.array([n[a:z].astype(np.int32).tobytes() for _, a, z in cuts], pa.binary()),
            "tokens": pa.array([token[a:z].tobytes() for _, a, z in cuts], pa.binary()),
            "df": pa.array([df[a:z].astype(np.int32).tobytes() for _, a, z in cuts], pa.binary())})

    return (packed.groupBy("block")
            .applyInArrow(run, "part int, keys binary, sizes binary, tokens binary, df binary"))


def _choose(df: np.ndarray, room: int, longest: int) -> int:
    """The l of least estimated cost. ``room``: shared tokens in the prefix of l = 1.

    A longer prefix scans more postings, one unit each; the candidates to verify, 8 units each,
    number at most the scanned postings divided by l, as each needs l matches."""
    most = min(longest, len(df) - room + 1)
    if most <= 1:
        return 1
    total = np.cumsum(df - 1)
    scanned = total[room - 1:room - 1 + most].astype(float)
    return int(np.argmin(scanned + 8 * scanned / np.arange(1, most + 1))) + 1


def _classes(shared: DataFrame, near: int, longest: int) -> DataFrame:
    """(key, n, tokens in order of (df, hash), matches l, prefix length) of every class that has
    enough shared tokens to be similar to anything."""

    def run(part: pa.Table) -> pa.Table:
        key, n = _joined(part, "keys", np.int64), _joined(part, "sizes", np.int32)
        token, df = _joined(part, "tokens", np.uint64), _joined(part, "df", np.int32)
        order = np.lexsort((token, df, key))
        key, n, token, df = key[order], n[order], token[order], df[order]
        starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
        ends = np.r_[starts[1:], len(key)]
        rows: list[tuple] = []
        for a, z in zip(starts, ends, strict=False):
            size, held = int(n[a]), int(z - a)
            need = -(-near * size // 100)
            if held < need:
                continue
            room = (size - need + 1) - (size - held)  # what own tokens leave of the prefix of l = 1
            room = max(room, 1)
            match = _choose(df[a:z], room, longest)
            rows.append((int(key[a]), size, held, token[a:z].tobytes(), match, room + match - 1))
        cols = list(zip(*rows, strict=False)) or [()] * 6
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.int32(), pa.int32()]
        return pa.table({c: pa.array(v, k) for c, v, k in
                         zip(("key", "n", "held", "tokens", "matches", "prefix"), cols, kinds, strict=True)})

    return (shared.groupBy("part")
            .applyInArrow(run, "key long, n int, held int, tokens binary, matches int, prefix int"))


def _postings(classes: DataFrame) -> DataFrame:
    """One row per prefix token of every class; rest: tokens after it in the class's order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                row = {c: batch.column(c)[i].as_py() for c in ("key", "n", "held", "matches", "prefix")}
                tokens = np.frombuffer(batch.column("tokens")[i].as_py(), np.uint64)[:row["prefix"]]
                size = len(tokens)
                rest = row["held"] - 1 - np.arange(size)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tokens.view(np.int64)), pa.array(rest.astype(np.int32))]
                    + [pa.array(np.full(size, row[c]), k) for c, k in
                       (("key", pa.int64()), ("n", pa.int32()), ("held", pa.int32()), ("matches", pa.int32()))],
                    ["token", "rest", "key", "n", "held", "matches"])

    return classes.select("key", "n", "held", "matches", "prefix", "tokens").mapInArrow(
        run, "token long, rest int, key long, n int, held int, matches int")


def _need(near: int) -> str:
    """Overlap that the sizes of x and y ask for."""
    return f"((cast({near} as long) * (x.n + y.n) + {99 + near}) div {100 + near})"


def _sides(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    side = classes.select("key", "n", "tokens")
    return (pairs.join(side.toDF("a", "na", "ta"), "a").join(side.toDF("b", "nb", "tb"), "b")
            .select("a", "b", "na", "nb", "ta", "tb"))


def _similar(x: np.ndarray, y: np.ndarray, nx: int, ny: int, near: int) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= near * (nx + ny - both)


def _verified(pairs: DataFrame, classes: DataFrame, near: int) -> DataFrame:
    """Pairs (a, b) whose whole sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [_similar(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), nx, ny, near)
                    for x, y, nx, ny in zip(*(batch.column(c).to_pylist() for c in ("ta", "tb", "na", "nb")), strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return _sides(pairs, classes).mapInArrow(run, "a long, b long")


def _met(pairs: DataFrame, classes: DataFrame, near: int) -> DataFrame:
    """Classes and their hubs (key, hub): sizes, whether similar, and the differences, those that
    the class lacks (missing of them) and those that it has more, as different numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for a, b, x, y, nx, ny in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "ta", "tb", "na", "nb")), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                lacks, more = np.setdiff1d(y, x, assume_unique=True), np.setdiff1d(x, y, assume_unique=True)
                parts = np.concatenate([lacks << np.uint64(1), (more << np.uint64(1)) | np.uint64(1)])
                out.append((a, b, nx, len(y), _similar(x, y, nx, ny, near), len(lacks), parts.view(np.int64).tolist()))
            cols = list(zip(*out, strict=True)) or [()] * 7
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.int32(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                                             ["key", "hub", "n", "hub_held", "linked", "missing", "parts"])

    return _sides(pairs, classes).mapInArrow(
        run, "key long, hub long, n int, hub_held int, linked boolean, missing int, parts array<long>")


def _hub_of(postings: DataFrame, near: int) -> DataFrame:
    """(a, b): every class that meets a hub, and the hub chosen for it."""
    hubs = (postings.groupBy("token")
            .agg(F.max(F.struct(F.expr("held / n").alias("share"), "key", "n", "held")).alias("h"), F.count("*").alias("m"))
            .where("m > 1").select("token", F.col("h.key").alias("hub"), "h.n", "h.held"))
    met = (postings.alias("x").join(hubs.alias("y"), "token")
           .where(f"x.key <> y.hub and least(x.held, y.held) >= {_need(near)}")
           .groupBy("key", "hub").agg(F.count("*").alias("m")))
    crowd = met.groupBy("hub").agg(F.count("*").alias("crowd"))
    own = Window.partitionBy("key")
    return (met.join(crowd, "hub").withColumn("most", F.max("m").over(own)).where("2 * m >= most")
            .groupBy("key").agg(F.max_by("hub", F.struct("crowd", "m", "hub")).alias("b")).withColumnRenamed("key", "a"))


def _within_hubs(met: DataFrame, near: int) -> DataFrame:
    """Candidate pairs of one hub and different roots, by the prefixes of their differences."""
    split = met.groupBy("hub").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high")
    part = (met.join(split, "hub", "left_semi")
            .select("hub", "hub_held", "key", "root", "n", "missing", F.size("parts").alias("size"), F.explode("parts").alias("part")))
    common = part.groupBy("hub", "part").agg(F.count("*").alias("often")).where("often > 1")
    order = Window.partitionBy("key").orderBy(F.desc("often"), "part")
    part = part.join(common, ["hub", "part"]).withColumn("after", F.row_number().over(order))  # it and those that follow
    k = f"(x.missing + y.missing - x.hub_held + {_need(near)})"
    pairs = (part.alias("x").join(part.alias("y"), ["hub", "part"])
             .where(f"x.key < y.key and x.root <> y.root and {k} > 0 and least(x.after, y.after) >= {k}")
             .select(F.col("x.key").alias("a"), F.col("y.key").alias("b")))
    cost = F.expr(f"{100 + near} * cast(missing as long) + {near} * cast(n as long)")
    least = met.groupBy("hub").agg(F.min_by(F.struct("key", "root"), F.struct(cost, "key")).alias("y"))
    star = met.alias("x").join(least, "hub").where("root <> y.root").select(F.col("key").alias("a"), F.col("y.key").alias("b"))
    return pairs.union(star).distinct()


def _across_hubs(postings: DataFrame, marks: DataFrame, near: int) -> DataFrame:
    """Candidate pairs of different hubs and roots, by their prefix tokens."""
    marked = (postings.join(marks, "key", "left")
              .withColumns({"root": F.coalesce("root", "key"), "hub": F.coalesce("hub", "key")}))
    lists = (marked.groupBy("token").agg(*[f(c).alias(f"{c}_{n}") for c in ("root", "hub") for n, f in (("a", F.min), ("z", F.max))])
             .where("root_a <> root_z and hub_a <> hub_z").select("token"))
    mixed = marked.join(lists, "token", "left_semi")
    matches = "least(x.matches, y.matches)"
    return (mixed.alias("x").join(mixed.alias("y"), "token")
            .where(f"x.key < y.key and x.root <> y.root and x.hub <> y.hub and least(x.held, y.held) >= {_need(near)} "
                   f"and least(x.rest, y.rest) + {matches} >= {_need(near)}")
            .groupBy(F.col("x.key").alias("a"), F.col("y.key").alias("b"))
            .agg(F.count("*").alias("m"), F.first(F.expr(matches)).alias("need")).where("m >= need").select("a", "b"))


def similar_classes(scratch: Scratch, docs: DataFrame, near: int = NEAR, size: int = SHINGLE,
                    longest: int = LONGEST) -> tuple[DataFrame, DataFrame]:
    """(links between class keys that connect all similar classes, (node, root) labels)."""
    width = shuffle_width(docs.sparkSession)
    blocks = 1 << max(4, (2 * width - 1).bit_length())
    classes = scratch.save(
        _classes(_shared_tokens(_packed(docs, blocks, size), blocks, 2 * width), near, longest), "classes")
    scratch.release()
    postings = scratch.save(_postings(classes), "postings")
    met = scratch.save(_met(_hub_of(postings, near), classes, near), "met")
    first = met.where("linked").select(F.col("key").alias("a"), F.col("hub").alias("b"))
    stars = components(scratch, first, "stars")
    marks = scratch.save(met.join(stars.withColumnRenamed("node", "key"), "key", "left")
                         .withColumn("root", F.coalesce("root", "key")), "marks")
    hub_roots = stars.withColumnRenamed("node", "key").join(met.select("key"), "key", "left_anti")  # hubs without one
    known = marks.select("key", "root", "hub").unionByName(hub_roots.withColumn("hub", F.col("key")))
    pairs = _within_hubs(marks, near).union(_across_hubs(postings, known, near)).distinct()
    second = scratch.save(_verified(pairs, classes, near), "links2")
    links = scratch.save(first.union(second), "links")
    labels = components(scratch, links, "all")
    scratch.drop("postings", "marks", "met", "classes", "links2", "stars-edges", "all-edges")
    scratch.release()
    return links, labels


def near_groups(docs: DataFrame, near: int = NEAR, size: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles, component_id, n_links of every row of ``docs`` (doc_id, text).

    n_links counts the class links kept to connect the component, not all similar pairs."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "ngram-join")
    rows = scratch.save(members(docs, size), "members")
    links, labels = similar_classes(scratch, docs, near, size)
    degree = (links.select(F.col("a").alias("key")).union(links.select("b"))
              .groupBy("key").agg(F.count("*").alias("n_links")))
    classes = rows.where("key is not null").groupBy("key").agg(F.min("doc_id").alias("first"))
    rooted = (classes.join(labels.toDF("key", "root"), "key", "left")
              .withColumn("root", F.coalesce("root", "key")))
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(smallest, "root").join(degree, "key", "left").select("key", "component_id", "n_links")
    return (rows.join(named, "key", "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
                    F.coalesce("n_links", F.lit(0)).alias("n_links")))


def keep_one(docs: DataFrame, near: int = NEAR, size: int = SHINGLE) -> DataFrame:
    """Of every component the document with the smallest doc_id, of equal rows one. A null doc_id
    is replaced by a large number, a hash of the text, meanwhile; documents without words all stay."""
    instead = F.xxhash64("text").bitwiseAND(F.lit((1 << 62) - 1)) + F.lit(1 << 62)
    key, text = fresh("near_join_id", docs.columns), fresh("near_join_text", docs.columns)
    named = docs.withColumns({key: F.coalesce(F.col("doc_id"), instead), text: F.xxhash64("text")})
    rows = near_groups(named.select(F.col(key).alias("doc_id"), "text"), near, size)
    stay = rows.where("n_shingles = 0 or doc_id = component_id").select(F.col("doc_id").alias(key)).distinct()
    return named.join(stay, key, "left_semi").dropDuplicates([key, text]).select(*[F.col(f"`{c}`") for c in docs.columns])


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


OP1_SQL = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'),
           lambda x: x <> '') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN w IS NULL OR len(w) = 0 THEN []
    WHEN len(w) < {SHINGLE} THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - {SHINGLE} + 2), lambda i: array_to_string(w[i:i + {SHINGLE} - 1], ' '))) END AS s
  FROM words),
flat AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS o
  FROM flat a JOIN flat b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM common WHERE 100 * o >= {NEAR} * (na + nb - o)),
reach AS (
  SELECT doc_id AS d, doc_id AS r FROM sets
  UNION SELECT reach.d, links.b FROM reach JOIN links ON reach.r = links.a)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, min(reach.r) AS component_id
FROM sets s JOIN reach ON reach.d = s.doc_id GROUP BY ALL
"""
