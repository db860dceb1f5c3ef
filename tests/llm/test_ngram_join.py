import random

import numpy as np
import pyarrow as pa
import pytest

from veritab.llm import ngram_join, words


def brute_sets(texts, size=5):
    out = []
    for t in texts:
        w = (t or "").encode().lower().split()
        out.append(set() if not w else {tuple(w)} if len(w) < size else {tuple(w[k:k + size]) for k in range(len(w) - size + 1)})
    return out


def brute_components(rows, near=75):
    sets, parent = brute_sets([t for _, t in rows]), list(range(len(rows)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for i, x in enumerate(sets):
        for j in range(i):
            if x and sets[j] and 100 * len(x & sets[j]) >= near * len(x | sets[j]):
                parent[find(i)] = find(j)
    smallest = {}
    for i, (d, _) in enumerate(rows):
        smallest[find(i)] = min(smallest.get(find(i), d), d)
    return {d: (len(sets[i]), smallest[find(i)]) for i, (d, _) in enumerate(rows)}


def near_copies(seed):
    r = random.Random(seed)
    rows = []
    passage = [f"p{k}" for k in range(40)]
    for _ in range(4):
        base = [r.choice("abcdefgh") + str(r.randrange(60)) for _ in range(r.choice([8, 20, 60, 146]))]
        base += passage if r.random() < 0.5 else []
        for _ in range(r.choice([3, 40])):
            w = list(base)
            for _ in range(r.randrange(8)):
                p, kind = r.randrange(len(w)), r.random()
                if kind < 0.7:
                    w[p] = f"e{r.randrange(10 ** 6 if r.random() < 0.7 else 4)}"
                elif kind < 0.85:
                    del w[p:p + 2]
                else:
                    w.insert(p, f"i{r.randrange(3)}")
                w = w or ["x"]
            rows.append((len(rows), " ".join(w)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_brute_force(spark, seed):
    rows = near_copies(seed)
    got = ngram_join.near_groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(rows)


def test_odd_rows(odd, odd_rows, empty):
    got = ngram_join.near_groups(odd).select("doc_id", "n_shingles", "component_id").collect()
    assert len(got) == len(odd_rows)
    by = {r.doc_id: r for r in got if r.doc_id is not None}
    assert by[2].component_id == by[10].component_id == 1  # copies, also in upper case
    assert by[3].n_shingles == by[4].n_shingles == by[5].n_shingles == 0
    assert [by[i].component_id for i in (3, 4, 5, 6)] == [3, 4, 5, 6]
    assert by[7].n_shingles == 1
    assert ngram_join.near_groups(empty).count() == 0


def test_keep_one_keeps_clean_rows(odd, empty):
    kept = ngram_join.keep_one(odd)
    assert kept.columns == odd.columns
    ids = sorted(r.doc_id for r in kept.collect() if r.doc_id is not None)
    assert ids == [1, 3, 4, 5, 6, 7, 8, 9]
    assert ngram_join.keep_one(empty).count() == 0


def test_shingle_hashes_follow_the_words():
    texts = ["a b c d e f", "A  B\tC D\nE F", "a b c", None, "", "é É x y z", "w" * 3_000_000 + " q r s t u", "x\x1cy a b c d"]
    got = dict(words.shingle_sets(pa.array(texts, pa.string())))
    want = brute_sets(texts)
    assert [len(got[i]) for i in range(len(texts))] == [len(s) for s in want]
    assert np.array_equal(got[0], got[1])
    assert not len(np.intersect1d(got[0], got[2]))


def test_words_do_not_depend_on_piece_borders(monkeypatch):
    text = " ".join("w" * (k % 9 + 1) + str(k) for k in range(3000))
    whole = dict(words.shingle_sets(pa.array([text])))[0]
    monkeypatch.setattr(words, "PIECE", 1000)
    words._cache.clear()
    assert np.array_equal(whole, dict(words.shingle_sets(pa.array([text])))[0])
    words._cache.clear()
