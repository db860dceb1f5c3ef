import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from veritab.llm import quality_rank


def documents(spark, n=400):
    r = np.random.default_rng(5)
    rows = []
    for i in range(n):
        words = [f"{r.choice(list('abcdefgh'))}{'etaoin'[r.integers(6)]}{r.integers(90)}" for _ in range(r.integers(20, 80))]
        good = i % 5 != 0
        rows.append((i, " ".join(words).capitalize() + "." if good else "!! ".join(w.upper() for w in words), int(good)))
    return rows, spark.createDataFrame(rows, "doc_id long, text string, quality int")


def test_held_out_documents_are_ranked(spark):
    rows, df = documents(spark)
    model = quality_rank.train(df.drop("quality"), df.select("doc_id", "quality"))
    got = {r.doc_id: r for r in quality_rank.score_quality(df.drop("quality"), model, ["doc_id"])
           .select("doc_id", "quality_score", quality_rank.held_out().alias("out")).collect()}
    out = [(got[i].quality_score, good) for i, _, good in rows if got[i].out]
    assert len(out) > 40
    best_bad, worst_good = max(s for s, g in out if not g), min(s for s, g in out if g)
    assert best_bad < quality_rank.THRESHOLD <= worst_good


def test_labels_of_held_out_rows_are_not_learnt(spark):
    _, df = documents(spark)
    labels = df.select("doc_id", "quality")
    flipped = labels.withColumn("quality", quality_rank.F.when(quality_rank.held_out(), 1 - labels.quality).otherwise(labels.quality))
    a, b = quality_rank.train(df.drop("quality"), labels), quality_rank.train(df.drop("quality"), flipped)
    assert np.array_equal(a.weights, b.weights) and a.cut == b.cut


def test_threshold_is_the_quantile_of_the_bad_share():
    x = np.linspace(0, 1, 200)[:, None] * np.ones((1, 3))
    good = x[:, 0] > 0.3
    model = quality_rank.fit_ranking(x, good, 0.3)
    assert abs(np.mean(model.score(x) < quality_rank.THRESHOLD) - 0.3) < 0.02
    assert np.all(np.diff(model.score(x)) >= 0)


def test_features_do_not_depend_on_the_rows_beside_them():
    texts = ["One line.\nTwo lines!", "", None, "x", "wort " * 300_000, "A B C"]
    together = quality_rank.features(pa.array(texts, pa.string()))
    for i, t in enumerate(texts):
        assert np.allclose(together[i], quality_rank.features(pa.array([t], pa.string()))[0])
    assert not together[1].any() and not together[2].any()


def test_odd_rows(spark, odd, odd_rows, empty):
    none = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, quality int")
    assert quality_rank.train(odd, none) is None
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 1), (9, 0), (6, 0), (7, 0), (12, 0)], "doc_id long, quality int")
    model = quality_rank.train(odd, labels)
    got = quality_rank.score_quality(odd, model, odd.columns).collect()
    assert len(got) == len(odd_rows)
    assert all(0 <= r.quality_score <= 1 for r in got)
    assert all(r.quality_score == 0 for r in got if not r.text)
    assert all(r.quality_score in (0.0, 0.5) for r in quality_rank.score_quality(odd, None, ["doc_id"]).collect())
    assert quality_rank.score_quality(empty, model, ["doc_id"]).count() == 0


def test_every_labelled_document_is_learnt(spark, monkeypatch):
    """The threshold lies between the two strengths at the bad share of all labelled documents, in many blocks too."""
    _, df = documents(spark, 900)
    docs, labels = df.drop("quality"), df.select("doc_id", "quality")
    known = {r.doc_id for r in labels.where(~quality_rank.held_out()).collect()}
    for block, few in ((500, 10_000), (60, 7)):
        monkeypatch.setattr(quality_rank, "BLOCK", block)
        monkeypatch.setattr(quality_rank, "FEW", few)
        seen = []
        keep = quality_rank._standard
        monkeypatch.setattr(quality_rank, "_standard", lambda sums: seen.append(sums[:2] * quality_rank.MOMENT_UNIT) or keep(sums))
        model = quality_rank.train(docs, labels)
        monkeypatch.setattr(quality_rank, "_standard", keep)
        good = labels.where(~quality_rank.held_out() & (F.col("quality") == 1)).count()
        assert list(seen[0]) == [len(known), good]  # at most 2,000 of a label before
        scores = np.sort([r.quality_score for r in quality_rank.score_quality(docs, model, ["doc_id"]).collect() if r.doc_id in known])
        bad = len(known) - good
        assert scores[bad - 1] < quality_rank.THRESHOLD < scores[bad]


def test_documents_of_a_rare_label_meet_all_others(spark, monkeypatch):
    """One bad document: it is copied to every block, so each good one is compared with it."""
    monkeypatch.setattr(quality_rank, "BLOCK", 20)
    _, df = documents(spark, 120)
    bad = df.where(~quality_rank.held_out()).first().doc_id
    labels = df.select("doc_id", F.when(F.col("doc_id") == bad, 0).otherwise(1).alias("quality"))
    pairs = []
    keep = quality_rank._descend
    monkeypatch.setattr(quality_rank, "_descend", lambda m, f: pairs.append(f(m.weights)[1] * quality_rank.SUM_UNIT) or keep(m, f, 2))
    assert quality_rank.train(df.drop("quality"), labels) is not None
    assert pairs == [labels.where(~quality_rank.held_out()).count() - 1]


def test_labels_are_joined_alike_at_every_size(spark, monkeypatch):
    plans, save = [], quality_rank.Scratch.save

    def kept(scratch, frame, name):
        plans.append(frame._jdf.queryExecution().executedPlan().toString())
        return save(scratch, frame, name)

    monkeypatch.setattr(quality_rank.Scratch, "save", kept)
    rows = [(i, "A plain line of words. " * (i % 5 + 1) if i % 2 else "!!" * (i % 7 + 1), i % 2) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    assert quality_rank.train(df.drop("quality"), df.select("doc_id", "quality")) is not None
    assert "SortMergeJoin" in plans[0] and "BroadcastHashJoin" not in plans[0]
