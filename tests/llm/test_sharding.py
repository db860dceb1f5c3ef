import datetime
import itertools
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from veritab.llm import sharding
from veritab.llm.shared import Scratch


@pytest.mark.parametrize(("dims", "bits"), [(2, 3), (3, 2)])
def test_curve_visits_every_cell_and_moves_one_step(spark, dims, bits):
    names = [f"x{i}" for i in range(dims)]
    cells = list(itertools.product(range(1 << bits), repeat=dims))
    df = spark.createDataFrame([(*c, *c) for c in cells], ", ".join(f"{p}{i} int" for p in "xo" for i in range(dims)))
    rows = sorted(sharding.hilbert_index(df, names, bits, "h").collect(), key=lambda r: r.h)
    assert [r.h for r in rows] == list(range(len(cells)))
    path = [[r[f"o{i}"] for i in range(dims)] for r in rows]
    assert all(sum(abs(a - b) for a, b in zip(p, q, strict=True)) == 1 for p, q in itertools.pairwise(path))


def test_documents_are_cut_evenly_with_gapless_slots(spark, odd, odd_rows, monkeypatch):
    monkeypatch.setattr(sharding, "SLICE", 3)  # several slices per cell
    got = sharding.shard_documents(odd, 4).collect()
    assert len(got) == len(odd_rows)
    sizes = Counter(r.shard for r in got)
    assert set(sizes) == {0, 1, 2, 3} and max(sizes.values()) - min(sizes.values()) <= 1
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    text = {i: t for i, t in odd_rows if i is not None}
    for r in got:
        if r.doc_id is not None:
            body = (text[r.doc_id] or "").encode()
            assert (r.size, r.text_crc32) == (len(body) + 16, zlib.crc32(body))


def test_shards_are_compact(spark):
    rows = [(i, i % 32, (i * 7) % 32, "s") for i in range(1024)]
    df = spark.createDataFrame(rows, "id long, a int, b int, source string")
    scratch = Scratch(spark, "test")
    got = sharding.hilbert_shards(scratch, df, ["a", "b"], ["id"], 16, 3).collect()
    spans = defaultdict(lambda: [99, -1, 99, -1])
    for r in got:
        s = spans[r.shard]
        spans[r.shard] = [min(s[0], r.a), max(s[1], r.a), min(s[2], r.b), max(s[3], r.b)]
    assert sum((s[1] - s[0] + 1) * (s[3] - s[2] + 1) for s in spans.values()) < 0.35 * 16 * 32 * 32


def test_strings_are_cut_by_their_whole_order(spark):
    """Values that agree in a long prefix, beside one without it, dates, nulls and ties."""
    rows = [(i, f"common-crawl-2023-{i % 8:02d}" if i % 100 else "books", datetime.date(2020, 1, 1 + i % 4) if i % 7 else None) for i in range(4_000)]
    df = spark.createDataFrame(rows, "id long, source string, day date")
    cells, names = sharding._cells(df, ["source", "day"], 4)
    got = cells.groupBy("source").agg(F.countDistinct(names[0]).alias("many"), F.min(names[0]).alias("cell")).orderBy("source").collect()
    at = [r.cell for r in got]
    assert all(r.many == 1 for r in got) and at == sorted(at) and len(set(at[1:])) == 8
    days = {r.day: r.cell for r in cells.groupBy("day").agg(F.min(names[1]).alias("cell")).collect()}
    assert days.pop(None) == 0 and [days[d] for d in sorted(days)] == [0, 1, 2, 3]
    none = df.withColumn("source", F.lit(None).cast("string"))
    assert {r[0] for r in sharding._cells(none, ["source"], 4)[0].select("cell_0").collect()} == {0}


def test_empty_table_and_fewer_rows_than_shards(spark, empty):
    assert sharding.shard_documents(empty, 4).count() == 0
    one = spark.createDataFrame([(1, "x", None, None)], "doc_id long, text string, lang string, source string")
    assert sharding.shard_documents(one, 4).first().slot == 0
