import random

import pytest

pytest.importorskip("ahocorasick")
from tokenizers import Tokenizer, models  # noqa: E402

from veritab.llm import token_count  # noqa: E402


def library(pieces, byte_pieces):
    vocabulary = [("<unk>", min(pieces.values())), *pieces.items()]
    if byte_pieces:
        vocabulary += [(f"<0x{b:02X}>", min(pieces.values())) for b in range(256)]
    return Tokenizer(models.Unigram(vocabulary, unk_id=0, byte_fallback=byte_pieces))


@pytest.mark.parametrize("byte_pieces", [True, False])
def test_counts_equal_the_library(byte_pieces):
    r = random.Random(3)
    for _ in range(30):
        pieces = {c: -float(r.randrange(3, 9)) for c in "abc▁" if r.random() < 0.8}
        for _ in range(12):  # few scores, so that ties are common
            pieces[r.choice(["", "▁"]) + "".join(r.choice("abc") for _ in range(r.randrange(1, 5)))] = -float(r.randrange(3, 9))
        counter, tokenizer = token_count.UnigramCounter(pieces, byte_pieces=byte_pieces, dummy_prefix=False), library(pieces, byte_pieces)
        for _ in range(30):
            text = "".join(r.choice("aabbcc▁xé") for _ in range(r.randrange(1, 25)))
            assert counter.count(text) == len(tokenizer.encode(text).ids), (pieces, text)


def test_whole_vocabulary_equals_the_library(spark, sf):
    public = pytest.importorskip("public_tokenizers")
    import sentencepiece
    path = public.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]
    tokenizer = Tokenizer(models.Unigram(pieces, unk_id=0, byte_fallback=True))
    docs = spark.read.parquet(f"{sf}/documents.parquet").where("n_chars < 3000")
    got = {r.doc_id: r.n_tokens for r in token_count.token_counts(docs, path).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert len(got) == len(texts)
    for i, n in got.items():
        assert n == len(tokenizer.encode("▁" + texts[i].replace(" ", "▁")).ids if texts[i] else [])


def test_odd_rows(odd, odd_rows, empty):
    path = pytest.importorskip("public_tokenizers").path("piece_bpe_32k.model")
    got = token_count.token_counts(odd, path).collect()
    assert len(got) == len(odd_rows)
    by = {r.doc_id: r.n_tokens for r in got if r.doc_id}
    assert by[3] == by[4] == 0 and by[1] == by[2] and by[7] > 60_000
    assert token_count.token_counts(empty, path).count() == 0
