import random
import re
from collections import Counter

import numpy as np
import pytest

from veritab.llm import suffix_dedup, word_repeats


def brute(texts):
    """The texts without every window of 51 words that has another place; equal texts count apart."""
    words = [[m.span() for m in re.finditer(rb"[^\x20\x09-\x0d]+", t.encode())] for t in texts]
    runs = [[tuple(t.encode()[a:z] for a, z in w[i:i + 51]) for i in range(len(w) - 50)] for t, w in zip(texts, words, strict=True)]
    count = Counter(x for r in runs for x in r)
    out = []
    for t, w, r in zip(texts, words, runs, strict=True):
        data, gone = t.encode(), np.zeros(len(t.encode()), dtype=bool)
        for i, x in enumerate(r):
            if count[x] > 1:
                gone[w[i][0]:w[i + 50][1]] = True
        out.append("" if r and texts.count(t) > 1 else bytes(b for b, g in zip(data, gone, strict=True) if not g).decode())
    return out


def shared_passages(seed):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdé.") for _ in range(r.randrange(1, 5)))
    prose = lambda n: [word() for _ in range(n)]
    passages = [prose(n) for n in (49, 50, 51, 52, 70)]
    texts = []
    for _ in range(40):
        t = prose(r.randrange(30))
        for _ in range(r.randrange(3)):
            p = list(r.choice(passages))
            if r.random() < 0.4:
                p[r.randrange(len(p))] = "#"
            t += p + prose(r.randrange(1, 30))
        texts.append("".join(w + r.choice((" ", "\n", "  ")) for w in t))
    same = " ".join(prose(55))
    return [*texts, same, same, " ".join(prose(40)), "", " ".join(["x"] * 60)]


@pytest.mark.parametrize("read", [word_repeats.READ, 7])
def test_equals_brute_force(spark, read, monkeypatch):
    monkeypatch.setattr(word_repeats, "READ", read)
    texts = shared_passages(read)
    texts = [t for t in texts if len(t.encode()) < 380] + [t[:379] for t in texts if len(t.encode()) >= 380]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.text for r in suffix_dedup.without_repeats(docs, passages=True).collect()}
    want = brute(texts)
    assert sum(a != b for a, b in zip(texts, want, strict=True)) > 10
    assert [got[i] for i in range(len(texts))] == want


def test_words_do_not_depend_on_piece_borders(monkeypatch):
    data = np.frombuffer(" ".join("ab" * (1 + i % 40) for i in range(500)).encode(), np.uint8)
    whole = word_repeats.words_of(data)
    monkeypatch.setattr(word_repeats, "PIECE", 90)
    part = word_repeats.words_of(data)
    assert all(np.array_equal(a, b) for a, b in zip(whole, part, strict=True)) and len(whole[0]) == 500


def test_odd_rows(odd, empty):
    by = {r.doc_id: r for r in suffix_dedup.without_repeats(odd, passages=True).collect() if r.doc_id is not None}
    assert by[3].text is None and by[4].text == "" and by[6].text == "x"
    assert by[7].text.strip() == "" and len(by[7].text) == by[7].n_chars
    assert suffix_dedup.without_repeats(empty, passages=True).count() == 0
