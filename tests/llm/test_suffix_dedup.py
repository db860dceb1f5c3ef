import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from veritab.llm import suffix_dedup


def brute(texts, length=400):
    """(removed bytes, spans, hash of the rest) by counting every string of the length."""
    data = [(t or "").encode() for t in texts]
    count = Counter(d[i:i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d) + 1, dtype=bool)
        for i in range(len(d) - length + 1):
            if count[d[i:i + length]] > 1:
                gone[i:i + length] = True
        kept = bytes(b for b, g in zip(d, gone, strict=False) if not g)
        out.append((len(d) - len(kept), int(np.sum(gone[1:] < gone[:-1])), hashlib.sha256(kept).hexdigest()))
    return out


def shared_passages(seed):
    r = random.Random(seed)
    prose = lambda n: "".join(r.choice("abcdefghij é.\n") for _ in range(n))
    passages = [prose(n) for n in (380, 400, 401, 700, 1500)]
    texts = []
    for _ in range(25):
        t = prose(r.randrange(600))
        for _ in range(r.randrange(3)):
            p = list(r.choice(passages))
            if r.random() < 0.5:
                p[r.randrange(len(p))] = "#"
            t += "".join(p) + prose(r.randrange(500))
        texts.append(t)
    texts += [texts[3], "ab" * 700, "ab" * 300 + "x" + "ab" * 300, prose(399), passages[1], "x" + passages[1] + "y"]
    return texts


def removed(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    out = {r.doc_id: (r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.digests(docs).collect()}
    return [out[i] for i in range(len(texts))]


@pytest.mark.parametrize(("crowd", "collection"), [(suffix_dedup.CROWD, 20), (suffix_dedup.CROWD, 1), (1, 20)])
def test_equals_brute_force(spark, crowd, collection, monkeypatch):  # collections, phase by phase, single strings
    monkeypatch.setattr(suffix_dedup, "CROWD", crowd)
    monkeypatch.setattr(suffix_dedup, "COLLECTION", collection)
    texts = shared_passages(crowd)
    assert removed(spark, texts) == brute(texts)


def test_transform_sorts_all_suffixes():
    r = np.random.default_rng(0)
    for _ in range(100):
        count = int(r.integers(1, 8))
        lengths = r.integers(0, 7, count)
        symbols = np.full((count, max(1, lengths.max())), -1, dtype=np.int32)
        for i in range(count):
            symbols[i, :lengths[i]] = r.integers(0, 3, lengths[i])
        string, column, prefix = suffix_dedup.insert_columns(symbols, lengths)
        got = [tuple(symbols[i, c:lengths[i]].tolist()) for i, c in zip(string, column, strict=True)]
        assert got == sorted(got)
        assert sorted(zip(string.tolist(), column.tolist(), strict=True)) == [(i, c) for i in range(count) for c in range(lengths[i] + 1)]
        for k in range(count, len(got)):
            a, b = got[k - 1], got[k]
            common = next((x for x, (p, q) in enumerate(zip(a, b, strict=False)) if p != q), min(len(a), len(b)))
            assert prefix[k] == common


def test_anchors_do_not_depend_on_piece_borders(monkeypatch):
    data = np.random.default_rng(1).integers(0, 4, 20_000).astype(np.uint8)
    whole = suffix_dedup.anchors(data)
    monkeypatch.setattr(suffix_dedup, "READ", 1000)
    part = suffix_dedup.anchors(data)
    assert all(np.array_equal(a, b) for a, b in zip(whole, part, strict=True))


def test_kept_text_keeps_whole_characters():
    data = "aéb".encode()
    assert suffix_dedup.kept_text(data, [(0, 2)]) == "éb"
    assert suffix_dedup.kept_text(data, [(2, 4)]) == "aé"
    assert suffix_dedup.kept_text(data, [(1, 3)]) == "ab"
    assert suffix_dedup.kept_bytes(data, [(0, 2)]) == data[2:]


def test_odd_rows(odd, empty):
    out = suffix_dedup.without_repeats(odd)
    assert out.columns == odd.columns
    by = {r.doc_id: r for r in out.collect() if r.doc_id is not None}
    assert by[3].text is None and by[4].text == "" and by[6].text == "x"
    assert by[7].text == "" and by[7].n_chars == 0  # one word again and again
    assert by[8].text == ""
    assert len(by[1].text) == by[1].n_chars
    assert suffix_dedup.without_repeats(empty).count() == 0
