import zlib
from collections import defaultdict

import numpy as np
import pytest

from veritab.llm import packing

public = pytest.importorskip("public_tokenizers")
PATH = public.path("word_bpe_49k.json")


def brute_sum_of_squares(lengths, capacity):
    gaps = []
    for s in lengths:
        choices = []
        for k, g in [*[(k, g) for k, g in enumerate(gaps) if g >= s], (None, capacity)]:
            after = [*gaps[:k], g - s, *gaps[k + 1:]] if k is not None else [*gaps, capacity - s]
            count = defaultdict(int)
            for x in after:
                count[x] += 1
            choices.append((sum(n * n for x, n in count.items() if x), k is None, g, k, after))
        gaps = min(choices, key=lambda c: c[:3])[4]
    return sorted(gaps)


def test_places_where_the_sum_of_squares_is_smallest():
    r = np.random.default_rng(0)
    for _ in range(30):
        lengths = r.integers(1, 13, 25)
        bins, offsets = packing.sum_of_squares(lengths, 12)
        filled = np.bincount(bins, lengths)
        assert filled.max() <= 12
        assert sorted((12 - filled).tolist()) == brute_sum_of_squares(lengths.tolist(), 12)
        for b in range(len(filled)):
            own = np.sort(offsets[bins == b])
            assert own[0] == 0


def test_tokens_equal_the_library(spark, sf):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(PATH)
    texts = ["", "a\x1cb c d e", "I'm's <|endoftext|>x <|STARTOFTEXT|> y<|startoftext|>", "é ́a é ñÑ ÀÖ÷×", "word, word. word!!? o'k' a.b",
             "ΣΑΣ İ ß 123 4a5", "日本語😀!! *** $$$a"]
    texts += [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").limit(100).collect()]
    for remembered in (packing.REMEMBERED, 400_0):
        words = packing.WordIds(PATH, remembered)
        for text, ids in zip(texts, words.encode([t.encode() for t in texts]), strict=True):
            assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_sequences_are_full_and_gapless(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = packing.pack_documents(docs, PATH, 512).collect()
    by, pieces = defaultdict(list), defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append((r.piece, r.start, r.length))
    for places in by.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 512
    assert len(by) <= 1.02 * sum(r.length for r in got) / 512 + 2
    assert len(pieces) == docs.count()
    for parts in pieces.values():
        parts.sort()
        assert [p for p, _, _ in parts] == list(range(len(parts)))
        assert all(n == 512 for _, _, n in parts[:-1]) and [s for _, s, _ in parts] == [512 * p for p, _, _ in parts]


def test_odd_rows(odd, odd_rows, empty):
    got = packing.pack_documents(odd, PATH).collect()
    alone = zlib.crc32(np.array([packing.END_ID], "<u4").tobytes())
    assert {(r.length, r.ids_crc32) for r in got if r.doc_id in (3, 4, 5)} == {(1, alone)}
    assert sum(r.piece == 0 for r in got) == len(odd_rows)
    assert max(r.length for r in got) == packing.CAPACITY and len([r for r in got if r.doc_id == 7]) > 10
    assert packing.pack_documents(empty, PATH).count() == 0
