from veritab.operators import score as SC

WEIGHTS = {"a": 1.0, "b": -1.0}


def test_good_and_bad_records_of_one_request(spark):
    rows = [(1, [{"a": 1.0, "b": 1.0}, {"a": 1.0}, None, {"a": None, "b": 2.0}, {"a": 3.0, "b": 1.0, "c": 9.0}]), (2, []), (3, None)]
    batch = spark.createDataFrame(rows, "request int, records array<map<string,double>>")
    scored = SC.score_batch(batch, "records", "request", WEIGHTS, 0.0)
    got = {(r.request, r.id): (r.prediction, r.error) for r in scored.collect()}
    assert got == {(1, 0): (1, None), (1, 1): (None, "missing features: b"), (1, 2): (None, "record is null"),
                   (1, 3): (None, "null features: a"), (1, 4): (1, None)}
    summary = {r.request: (r.total, r.successful, r.failed) for r in SC.batch_summary(batch, "records", "request", scored).collect()}
    assert summary == {1: (5, 2, 3), 2: (0, 0, 0), 3: (0, 0, 0)}
