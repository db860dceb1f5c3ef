import random

import pytest

from tests.llm.test_ngram_join import brute_sets
from veritab.llm import decontaminate


def case():
    r = random.Random(4)
    word = lambda: r.choice("abcdef") + str(r.randrange(30))
    items = [" ".join(word() for _ in range(n)) for n in (1, 3, 5, 6, 12, 40, 40, 300)] + ["", None, "  "]
    docs = []
    for i in range(60):
        parts = [word() for _ in range(r.choice([0, 10, 200, 3000]))]
        for _ in range(r.randrange(3)):
            w = (r.choice(items) or "").split()
            for _ in range(r.randrange(4)):
                if w:
                    w[r.randrange(len(w))] = "Z"
            at = r.randrange(len(parts) + 1)
            parts[at:at] = w
        docs.append((i, " ".join(parts)))
    docs += [(60, None), (61, ""), (62, items[1].upper()), (None, items[5]), (5, items[6])]
    return docs, list(enumerate(items))


@pytest.mark.parametrize("block", [decontaminate.BLOCK_BYTES, 200])  # one block, several
def test_equals_brute_force(spark, block):
    docs, items = case()
    df = spark.createDataFrame([(*d, -1) for d in docs], "doc_id long, text string, item_id int")
    got = decontaminate.contained_items(df, spark.createDataFrame(items, "item_id long, text string"), block_bytes=block).collect()
    want = []
    item_sets = brute_sets([t for _, t in items])
    for (i, _), s in zip(docs, brute_sets([t for _, t in docs]), strict=True):
        want += [(i, k, len(x), len(s & x)) for (k, _), x in zip(items, item_sets, strict=True) if x and 100 * len(s & x) >= 75 * len(x)]
    key = lambda x: (x[0] is None, x)
    assert sorted(((r.doc_id, r.item_id, r.n_item_shingles, r.n_shared) for r in got), key=key) == sorted(want, key=key)
    assert len(want) > 20


def test_only_rows_with_an_item_go(spark, odd, empty):
    items = spark.createDataFrame([(1, "x"), (2, None)], "item_id long, text string")
    kept = decontaminate.without_items(odd, items)
    assert kept.columns == odd.columns and kept.count() == odd.count() - 1
    assert decontaminate.without_items(odd, items.limit(0)).count() == odd.count()
    assert decontaminate.without_items(empty, items).count() == 0
    assert decontaminate.contained_items(empty, items).count() == 0
