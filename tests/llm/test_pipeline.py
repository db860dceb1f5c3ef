import os
import shutil

import pytest

import corpus_pipeline
from veritab.llm import queries
from veritab.llm.shared import Scratch


def test_every_operator_has_one_query():
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.queries())
    assert numbers == list(range(1, 14))
    assert set(queries.oracle_sql()) == {n for n in queries.queries() if n.split("_")[0] in ("op1", "op2", "op8", "op11", "op12")}


def test_stages_keep_clean_documents_and_catch_the_rest(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    benchmark = spark.read.parquet(f"{sf}/benchmark.parquet").first().text
    prose = docs.where("lang = 'en' and n_chars > 2500").join(spark.read.parquet(f"{sf}/labels.parquet").where("quality = 1"), "doc_id").first().text
    words = prose.split(" ")
    near = " ".join([*words[:60], "changed", *words[61:]])
    more = spark.createDataFrame([(10_001, prose), (10_002, near), (10_003, " ".join(reversed(words)) + " " + benchmark)], "doc_id long, text string")
    docs = docs.unionByName(more, allowMissingColumns=True)
    scratch, columns = Scratch(spark, "test"), docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = scratch.save(stage(spark, docs, sf), name)
        kept[name] = {r.doc_id for r in docs.select("doc_id").collect()}
        assert name == "packing" or docs.columns == columns
    assert {10_001, 10_002, 10_003} <= kept["quality"]
    assert not {10_001, 10_002} & kept["near_duplicates"] and 10_003 in kept["near_duplicates"]
    assert kept["repeats"] == kept["near_duplicates"]
    assert 10_003 not in kept["decontamination"]
    assert kept["packing"] == kept["decontamination"]
    assert len(kept["quality"]) > 0.75 * 200


def test_other_queries_work_without_this_subpackage(tmp_path):
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    shutil.copytree(os.path.join(root, "veritab"), tmp_path / "veritab", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(root, "__spark_entry__.py"), tmp_path)
    code = "import __spark_entry__ as e; n = list(e.queries()); assert len(n) > 100 and not [x for x in n if x.startswith('op') or x == 'pipeline']; e.oracle_sql()"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    assert subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, check=False).returncode == 0


@pytest.mark.parametrize("name", ["op3_token_counts", "op4_hilbert_sharding", "op9_language_id"])
def test_queries_return_every_document(spark, sf, name):
    assert queries.queries()[name](spark, sf).count() == spark.read.parquet(f"{sf}/documents.parquet").count()


def test_repeats_stage_catches_passages_of_51_words(spark, sf):
    passage = " ".join(f"w{i:02d}yz"[:4 + i % 2] for i in range(51))
    assert len(passage.split()) == 51 and len(passage) <= 300
    others = [" ".join(f"{a}{i}" for i in range(300)) for a in "pqrs"]
    short = " ".join(passage.split()[:50])
    rows = [(1, f"{others[0]} {passage} end"), (2, f"start\n{passage}\n{others[1]}"), (3, f"{others[2]} {short} z"), (4, others[3])]
    docs = spark.createDataFrame([(i, t, len(t)) for i, t in rows], "doc_id long, text string, n_chars long")
    out = {r.doc_id: r for r in corpus_pipeline.repeats(spark, docs, sf).collect()}
    assert out[1].text == f"{others[0]}  end" and out[2].text == f"start\n\n{others[1]}"
    assert out[3].text == rows[2][1] and out[4].text == rows[3][1]
    assert all(r.n_chars == len(r.text) for r in out.values())


def test_quality_stage_keeps_all_documents_without_a_model(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(20)
    spark.read.parquet(f"{sf}/labels.parquet").where("quality = 1").write.parquet(f"{tmp_path}/labels.parquet")
    out = corpus_pipeline.quality(spark, docs, str(tmp_path))
    assert out.columns == docs.columns and out.count() == docs.count() == 20
