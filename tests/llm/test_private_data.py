import hashlib
import random
import re

from pyspark.sql import functions as F

from veritab.llm import private_data as pd13

CONTRACT = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def luhn(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        d = int(d) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def brute(text):
    out = []
    for at, (kind, pattern) in enumerate(CONTRACT.items()):
        for m in pattern.finditer(text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card" and not (12 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((m.start(), at, m.end()))
    return sorted(out)


def base_of(spark, texts):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(4, "doc_id")
    rows = pd13.Scratch(spark, "test").save(pd13.hits_of(docs), "rows")
    found = {i: [] for i in range(len(texts))}
    for r in pd13.occurrences_of(rows).where("base").join(rows.select("rid", "doc_id"), "rid").select("doc_id", "start", "at", "end").collect():
        found[r[0]].append(tuple(r[1:]))
    return [sorted(found[i]) for i in range(len(texts))]


PARTS = ["a@b.c", "_d@e.f", "x.y+z@host-1.example.com", "@", "1.2.3.4", "256.1.1.1", "1.2.3.4.5.6.7.8.9", "007.0.0.255",
         "4111 1111 1111 1111", "4111-1111-1111-1112", "123456789012", "+1 (171) 555-2028", "+12", "+1 2 3 4 5 6 7 8 9 ",
         "é", "𝒳", " ", "-", ".", "+", "9", "12", "word", "\n", "00000000000000"]


def test_base_spans_equal_the_contract(spark):
    rng = random.Random(13)
    texts = ["".join(rng.choices(PARTS, k=rng.randrange(15))) for _ in range(2_000)]
    assert base_of(spark, texts) == [brute(t) for t in texts]


def test_base_spans_of_long_and_odd_texts(spark):
    texts = [None, "", "a" * 10_000, "1" * 10_000, "1 " * 50_000, "1." * 50_000, "+1" + "(" * 100_000, "a@b.c " * 5_000, "é4111111111111111 " * 3_000,
             "a@" * 50_000, "x\r\n\x00 1.2.3.4"]
    assert base_of(spark, texts) == [brute(t) for t in texts]


def spans_of(spark, texts, **kw):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    return {r["doc_id"]: (sorted(map(tuple, r["base"])), sorted(map(tuple, r["added"]))) for r in pd13.private_spans(docs, **kw).collect()}


def test_contexts_of_seeds_find_unseen_identifiers(spark):
    seeds = [f"please write to user{i}@mail.example.com today or call +1 (555) 123-45{i:02d} now" for i in range(6)]
    texts = [*seeds, "please write to root@localhost today", "please call or call (555) 123-4599 now", "the year 555 123-4599 was fine",
             "meet root@localhost somewhere", *[seeds[0]] * 5]
    found = spans_of(spark, texts)
    assert found[6] == ([], [(16, 0, 30)])
    assert found[7] == ([], [(20, 3, 34)])
    assert found[8] == found[9] == ([], [])
    assert all(found[i][1] == [] and found[i][0] == brute(t) for i, t in enumerate(texts[:6]))


def test_one_identifier_in_many_copies_is_no_support(spark):
    texts = ["write to user@mail.example.com today"] * 50 + ["write to root@localhost today"]
    assert spans_of(spark, texts)[50] == ([], [])


def test_candidates_found_in_round_two_support_new_patterns(spark):
    texts = [f"mail to u{i}@mail.example.com today" for i in range(80)]
    texts += [f"mail to host{i}@local today" for i in range(20)] + [f"old address host{i}@local hidden there" for i in range(20)]
    texts += ["old address other@place hidden there"]
    assert spans_of(spark, texts, rounds=1, trust=0.7)[120] == ([], [])
    assert spans_of(spark, texts, trust=0.7)[120] == ([], [(12, 0, 23)])


def brute_patterns(edges, rounds, support, trust):
    belief = {}
    for _, at, value, seed in edges:
        belief[at, value] = max(belief.get((at, value), 0.0), float(seed))
    for step in range(rounds):
        confidence = {}
        for key in {(p, at) for p, at, _, _ in edges}:
            own = [belief[at, v] for p, at, v, _ in edges if (p, at) == key]
            if sum(b >= trust for b in own) >= support:
                confidence[key] = sum(own) / (len(own) + 1)
        if step < rounds - 1:
            for p, at, v, _ in edges:
                belief[at, v] = max(belief[at, v], confidence.get((p, at), 0.0))
    return {k: round(c, 9) for k, c in confidence.items() if c >= trust}


def test_scores_equal_brute_force(spark):
    rng = random.Random(3)
    edges = sorted({(f"p{rng.randrange(12)}", rng.randrange(2), f"v{rng.randrange(40)}") for _ in range(300)})
    edges = [(p, at, v, rng.random() < 0.6) for p, at, v in edges]
    scratch = pd13.Scratch(spark, "test")
    for trust in (0.5, 0.6):
        got = pd13.confident_patterns(scratch, spark.createDataFrame(edges, "pattern string, at int, value string, seed boolean"), 3, 3, trust)
        assert {(r["pattern"], r["at"]): round(r["confidence"], 9) for r in got.collect()} == brute_patterns(edges, 3, 3, trust)


def test_query_on_odd_rows(spark, odd, odd_rows, tmp_path):
    for name, df in (("full", odd), ("none", odd.where("doc_id < 0"))):
        for c in ("rid", "base", "seeds", "loose", "text2", "pattern", "at", "value"):
            df = df.withColumn(c, F.lit("x"))
        df.write.parquet(str(tmp_path / name / "documents.parquet"))
    got = pd13.op13_private_data(spark, str(tmp_path / "full")).collect()
    empty = hashlib.sha256(b"").hexdigest()
    assert len(got) == len(odd_rows) and {r["base_sha256"] for r in got} == {empty} and {r["spans"] for r in got} == {""}
    assert pd13.op13_private_data(spark, str(tmp_path / "none")).collect() == []


def test_query_columns_on_documents(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = pd13.op13_private_data(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = brute(texts[r["doc_id"]])
        names = [f"{pd13.KINDS[k]}:{a}:{z}" for a, k, z in base]
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == [sum(k == i for _, k, _ in base) for i in range(4)]
        assert r["base_sha256"] == hashlib.sha256(",".join(names).encode()).hexdigest()
        assert set(names) <= set(filter(None, r["spans"].split(",")))
