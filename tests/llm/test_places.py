import numpy as np
import pyarrow as pa
import pytest

from veritab.llm import places, suffix_dedup
from veritab.llm.shared import Scratch


def test_merged_spans_equal_plain_merging():
    r = np.random.default_rng(0)
    for _ in range(50):
        cells = np.stack([r.integers(-3, 3, 40), r.integers(0, 200, 40), np.zeros(40, np.int64)], axis=1)
        cells[:, 2] = cells[:, 1] + r.integers(1, 30, 40)
        key, spans = places.merged(cells)
        for k in np.unique(cells[:, 0]):
            assert [tuple(x) for x in spans[key == k]] == suffix_dedup.merge_spans([cells[cells[:, 0] == k][:, 1:].tobytes()])
    assert len(places.merged(np.zeros((0, 3), np.int64))[0]) == 0


@pytest.mark.parametrize("blocks", [16, 64])
def test_packed_rows_come_back(blocks):
    cells = np.random.default_rng(1).integers(-2 ** 63, 2 ** 63 - 1, (500, 3))
    batch = places.packed(cells, blocks)
    assert len(set(batch.column("block").to_pylist())) == len(batch) <= blocks
    assert sorted(map(tuple, places.unpacked(pa.Table.from_batches([batch]), 3))) == sorted(map(tuple, cells))
    assert len(places.packed(cells[:0], blocks)) == 0


def test_a_common_value_makes_no_row_for_every_place(spark):
    scratch = Scratch(spark, "test-places")
    rows = spark.range(0, 20_000, 1, 3).selectExpr("if(id % 2 = 0, -7L, id) AS gram", "xxhash64(id) AS key", "id AS place")
    found, blocks = places.repeated_places(scratch, rows.union(rows.where("id < 100")), "gram", ["place"], "grams")
    assert {r.gram for r in found.collect()} == {-7} and found.count() == places.SALTS
    cells = places.dealt(found, blocks, "gram")
    assert cells.count() <= 3 * blocks
    texts = places.by_text(cells, ["places", "grams"]).selectExpr("key", "octet_length(places) AS n", "grams").collect()
    assert len(texts) == 10_000 and {r.n for r in texts} == {8} and {np.frombuffer(r.grams, np.int64)[0] for r in texts} == {-7}


def test_segments_of_a_common_passage_make_no_row_for_every_text(spark):
    r = np.random.default_rng(3)
    prose = lambda n: "".join(map(chr, r.integers(97, 122, n)))
    passage = prose(3_000)
    scratch, texts = Scratch(spark, "test-segments"), [prose(500) + passage + prose(500) for _ in range(200)]
    keyed = suffix_dedup.with_keys(spark.createDataFrame([(t,) for t in texts], "text string").repartition(2)).select("key", "text").cache()
    made = {}
    save = scratch.save

    def kept(frame, name):
        made[name] = save(frame, name)
        return made[name]

    scratch.save = kept
    spans = suffix_dedup.repeated_spans(scratch, keyed).collect()
    runs = [x[1] - x[0] for s in spans for x in suffix_dedup.merge_spans(s.pieces)]
    assert len(spans) == len(runs) == 200 and all(3_000 <= n < 3_020 for n in runs)  # neighbours can agree by chance
    places = made["segments"].selectExpr("sum(size(places))").first()[0]
    assert made["segments"].count() < 0.6 * places
    keyed.unpersist()
