import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from veritab.llm import phrases as ph

SCHEMA = "doc_id long, text string, lang string"


def brute(rows, least, first):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    f, n = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for d in range(1, 5):
                for i in range(len(w) - d + 1):
                    f[lang, tuple(w[i:i + d])] += 1
    found = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    most = Counter()
    for (lang, p), a in found.items():
        for m in range(2, len(p)):
            for i in range(len(p) - m + 1):
                most[lang, p[i:i + m]] = max(most[lang, p[i:i + m]], a)
    out = []
    for (lang, p), a in found.items():
        if 100 * most[lang, p] >= 80 * a:
            continue
        s, _, left, right = min((2000000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
        out.append((lang, -s, -a, " ".join(p).encode(), left, right))
    rank, result = Counter(), []
    for lang, s, a, p, left, right in sorted(out):
        rank[lang] += 1
        if rank[lang] <= first:
            result.append((lang, rank[lang], p.decode(), -a, left, right, n[lang], -s))
    return sorted(result)


def mined(spark, rows, least=3, first=50, **kw):
    return sorted(tuple(r) for r in ph.collocations(spark.createDataFrame(rows, SCHEMA), least, first, **kw).collect())


def prose(seed, many, words=40):
    rng = np.random.default_rng(seed)
    vocabulary = ["the", "of", "New", "York", "été", "a", "b", "c", "straße"] + [f"w{i}" for i in range(30)]
    shares = np.r_[np.full(9, 6.0), np.full(30, 1.0)]
    out = []
    for i in range(many):
        text = ""
        for w in rng.choice(vocabulary, words, p=shares / shares.sum()):
            text += str(w) + str(rng.choice([" ", "  ", ", ", ".\n", "\t", "\x0b"], p=[0.8, 0.05, 0.05, 0.05, 0.03, 0.02]))
        out.append((i, text, [None, "en", "fr"][int(rng.integers(0, 3))]))
    return out


@pytest.mark.parametrize("budget", [10 ** 6, 200, 3])
def test_counts_and_scores_equal_brute_force(spark, budget):
    rows = prose(1, 60) + [(100 + i, "one hot phrase here. one hot phrase here", "en") for i in range(40)]
    assert mined(spark, rows, budget=budget) == brute(rows, 3, 50)


def test_few_rows_per_language_and_ties(spark):
    rows = prose(2, 60)
    assert mined(spark, rows, first=3) == brute(rows, 3, 3)
    ties = [(i, "b a. a b. c d. d c", "en") for i in range(5)]
    assert mined(spark, ties, first=3) == brute(ties, 3, 3)


def test_odd_rows(spark, odd, odd_rows, empty):
    rows = [(i, t, "en" if t else None) for i, t in odd_rows]
    found = sorted(tuple(r) for r in ph.collocations(odd, 2, 50).collect())
    assert found == brute(rows, 2, 50)
    assert ph.collocations(empty, 2, 50).collect() == []


def test_small_pieces_give_the_same_words(monkeypatch):
    """Long texts are read in parts; phrases over a cut are kept."""
    text = " ".join(p for _, p, _ in prose(3, 20))
    batch = pa.RecordBatch.from_pydict({"text": ["x y", text, "", "tail of it"], "lang": ["en"] * 4})
    full = np.full(1 << 20, 255, np.uint8)

    def leaves():
        total = Counter()
        for symbols, key, weight in ph._leaves(iter([batch]), full):
            for *p, w in zip(*(symbols[ph._column(key, k)] for k in range(4)), weight):
                total[tuple(int(x) for x in p)] += int(w)
        return total

    whole = leaves()
    monkeypatch.setattr(ph, "PIECE", 64)
    monkeypatch.setattr(ph, "FLUSH", 20)
    monkeypatch.setattr(ph, "pieces_of_rows", lambda offsets: [(i, i + 1) for i in range(len(offsets) - 1)])
    assert leaves() == whole


def test_long_word_has_the_hash_of_a_short_read(monkeypatch):
    data = np.frombuffer(b"abcdefghij" * 30, np.uint8)
    short, *_ = ph.words_in(data, np.zeros(1, np.int64), np.zeros(1, np.uint64))
    monkeypatch.setattr(ph, "PIECE", 64)
    assert ph.words_in(data, np.zeros(1, np.int64), np.zeros(1, np.uint64))[0] == short


def test_large_vocabulary_is_halved(monkeypatch):
    rng = np.random.default_rng(4)
    symbol = rng.integers(1, 1 << 62, 70_000).astype(np.uint64)
    symbol = np.r_[symbol, symbol]
    total = Counter()
    for symbols, key, weight in ph._suffixes(symbol, np.zeros(len(symbol), np.int64), np.full(1 << 20, 255, np.uint8), len(symbol)):
        for a, b, w in zip(symbols[ph._column(key, 0)], symbols[ph._column(key, 1)], weight):
            total[int(a), int(b)] += int(w)
    assert total == Counter(zip(symbol[:-1].tolist(), symbol[1:].tolist()))


def test_query_equals_its_sql(spark):
    con = duckdb.connect()
    con.sql("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.001/documents.parquet'")
    want = sorted(con.sql(ph.OP11_SQL).fetchall())
    assert sorted(tuple(r) for r in ph.op11_phrase_collocations(spark, "/root/testdata/sf0.001").collect()) == want != []
