import numpy as np
import pytest

from veritab.llm import language


def test_gradients_equal_finite_differences():
    model = language.ByteGru(["a", "b"], hidden=3, seed=1)
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    seq, lengths = language.padded([b"abc", b"x", b"yz"])
    target = np.array([0, 1, 1])

    def loss():
        return model.gradients(seq, lengths, target)[0]

    _, grad = model.gradients(seq, lengths, target)
    for name, at in [("xf", (97, 2)), ("xb", (32, 7)), ("uf", (1, 4)), ("ub", (0, 0)), ("vf", (2, 1)), ("vb", (1, 1)), ("o", (4, 1)), ("c", (0,))]:
        old = model.p[name][at]
        model.p[name][at] = old + 1e-3
        up = loss()
        model.p[name][at] = old - 1e-3
        down = loss()
        model.p[name][at] = old
        assert grad[name][at] == pytest.approx((up - down) / 2e-3, rel=0.02, abs=2e-5), name


def test_batches_do_not_change_the_labels():
    model = language.ByteGru(["a", "b", "c"])
    words = [b"abc", b"x", "é".encode() * 9, b"w" * 24]
    seq, lengths = language.padded(words)
    together = model.log_probabilities(seq, lengths).sum(axis=0)
    for i, w in enumerate(words):
        alone = model.log_probabilities(*language.padded([w])).sum(axis=0)[0]
        assert np.allclose(together[i], alone, atol=1e-4)


def test_held_out_accuracy(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = language.train(docs)
    got = language.label_languages(docs, model).collect()
    truth = {r.doc_id: (r.lang, r.out) for r in docs.select("doc_id", "lang", language.held_out().alias("out")).collect()}
    out = [truth[r.doc_id][0] == r.lang_pred for r in got if truth[r.doc_id][1] and r.lang_pred != "und"]
    assert len(out) > 20 and np.mean(out) > 0.95
    assert all(0 <= r.score <= 1 for r in got)


def test_odd_rows(odd, odd_rows, empty):
    model = language.train(odd)
    got = language.label_languages(odd, model).collect()
    assert len(got) == len(odd_rows)
    by = {r.doc_id: r.lang_pred for r in got if r.doc_id is not None}
    assert [by[i] for i in (3, 4, 5, 9)] == ["und"] * 4 and by[6] == "en"
    assert {r.lang_pred for r in language.label_languages(odd, None).collect()} == {"und"}
    assert language.train(empty) is None and language.label_languages(empty, model).count() == 0


def test_training_sample_is_bounded_and_takes_whole_texts(spark):
    rows = [(i, f"{lang}{i} " * 10, lang) for i in range(300) for lang in ("aa", "bb")] * 2 + [(1, "x" * 5_000, "aa"), (2, "y " * 9_000, "cc"), (3, "z", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    free = docs.where(~language.held_out())
    got = language.training_words(docs, 10**9, 10**6)
    ids = {r.doc_id for r in free.where("lang = 'aa'").collect()}
    assert set(got) == {"aa", "bb", "cc"} and set(got["aa"]) == {f"aa{i}".encode() for i in ids} and set(got["aa"].values()) == {10}
    few = language.training_words(docs, 400, 5)
    assert all(0 < len(few[k]) <= 5 and sum(len(w) + 1 for w in few[k].elements()) <= 400 for k in ("aa", "bb"))
    assert few["cc"] == got["cc"] == language.training_words(docs.repartition(2), 400, 5)["cc"]
    assert few == language.training_words(docs.repartition(3), 400, 5)


def test_remembered_table_may_overflow(monkeypatch):
    model = language.ByteGru(["a", "b"])
    texts = [b" ".join(b"w%d" % i for i in range(n)) for n in (300, 1, 0, 40)]
    whole = language.Scorer(model).pooled(texts)
    assert np.allclose(whole[2], 0.5)
    monkeypatch.setattr(language, "REMEMBERED", 50)
    monkeypatch.setattr(language, "TOGETHER", 30)
    assert np.allclose(whole, language.Scorer(model).pooled(texts))
