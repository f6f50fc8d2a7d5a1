import re
import subprocess
import sys
from pathlib import Path

import pytest

import corpus_pipeline
from checks.compare import differences, duck, plan
from shelfmark.llm import oracle, queries
from shelfmark.llm import packing, quality, secrets
from tests.llm.test_links import brute_force
from tests.llm.test_native import spans

FOLDER = "/root/testdata/sf0.001"
REPO = Path(__file__).resolve().parents[2]


@pytest.mark.parametrize("name", sorted(oracle.SQL))
def test_query_equals_its_sql(spark, name):
    assert differences(queries.QUERIES[name](spark, FOLDER), duck(FOLDER), oracle.SQL[name]) == ""


def test_every_operator_has_one_query():
    numbers = sorted(int(n.split("_")[0][2:]) for n in queries.QUERIES if n != "pipeline")
    assert numbers == list(range(1, 14)) and "pipeline" in queries.QUERIES


@pytest.mark.parametrize("name", ["op4_chat_formatting", "op7_secret_scans", "op9_url_filters"])
def test_native_queries_run_no_python(spark, name):
    text = plan(queries.QUERIES[name](spark, FOLDER))
    assert not any(word in text for word in ("Python", "Arrow", "Pandas", "Cartesian"))


def pieces_of(texts, size=80):
    """All pieces of some length, as the search reads texts: lower case, with one blank between words."""
    plain = [" ".join(re.findall(r"[^\W_]+", (t or "").lower())) for t in texts]
    return {p[i : i + size] for p in plain for i in range(len(p) - size + 1)}


def test_each_stage_does_its_work_on_what_the_one_before_kept(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality classifier", "near-duplicates", "decontamination", "secret scans", "packing"]
    quality_stage, near_stage, leak_stage, secret_stage, pack_stage = (f for _, f in corpus_pipeline.STAGES)
    good = quality_stage(spark, docs, FOLDER).cache()
    assert good.columns == docs.columns and 0.8 * docs.count() < good.count() < docs.count()

    scores = {r.doc_id: r.score for r in quality.quality_scores(docs, spark.read.parquet(f"{FOLDER}/labels.parquet")).collect()}
    assert {r.doc_id for r in good.collect()} == {d for d, score in scores.items() if score >= 0.5}

    texts = [(r.doc_id, r.text) for r in good.collect()]
    near = near_stage(spark, good, FOLDER).cache()
    kept = {d for d, n, _, k in brute_force(texts) if k}
    assert {r.doc_id for r in near.collect()} == kept

    clean = leak_stage(spark, near, FOLDER).cache()
    items = [r.text for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    left, pieces = {r.doc_id for r in clean.collect()}, pieces_of(items)
    verbatim = {d for d, t in texts if d in kept and pieces & pieces_of([t])}
    # whole passages are never left in, and what is dropped beyond them holds a fifth of one
    assert verbatim and not left & verbatim
    near = pieces_of(items, 15)
    assert all(near & pieces_of([t], 15) for d, t in texts if d in kept and d not in left)

    masked = secret_stage(spark, clean, FOLDER).cache()
    assert masked.columns == docs.columns and masked.count() == clean.count()
    assert all(not spans(r.text) for r in masked.collect())

    packed = pack_stage(spark, masked, FOLDER).collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in masked.collect()}
    run = corpus_pipeline.run(spark, FOLDER).collect()
    piece = lambda r: (r.doc_id, r.piece, r.start, r.length, r.ids_crc32)
    assert sorted(map(piece, run)) == sorted(map(piece, packed))
    assert len({r.sequence_id for r in run}) == -(-sum(r.length for r in run) // packing.CAPACITY)


def test_an_empty_table_passes_all_stages(spark, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{FOLDER}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_the_rest_imports_without_this_folder(tmp_path):
    script = (
        "import sys, importlib.abc\n"
        "class Gone(importlib.abc.MetaPathFinder):\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name.split('.')[0] == 'corpus_pipeline' or name.startswith('shelfmark.llm'):\n"
        "            raise ModuleNotFoundError(f'No module named {name!r}', name=name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "assert e.queries() and not any(n.startswith('op') or n == 'pipeline' for n in e.queries())\n"
    )
    subprocess.run([sys.executable, "-c", script], cwd=REPO, check=True)
    assert secrets.__name__ == "shelfmark.llm.secrets"
