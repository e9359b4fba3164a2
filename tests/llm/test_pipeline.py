import os
import shutil
import subprocess
import sys
from pathlib import Path

import corpus_pipeline
from gridloom.llm import pii, probminhash
from gridloom.llm.common import materialise

ROOT = Path(__file__).resolve().parents[2]
DATA = "/root/testdata/sf0.001"


def test_every_stage_acts_on_what_the_one_before_kept(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "pii", "packing"]
    sizes = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = materialise(stage(spark, docs, DATA), name)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        docs = out
        sizes.append(docs.count())
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] == sizes[-2] and sizes[-1] > 0.7 * sizes[0]
    assert probminhash.classes_of(docs).filter("NOT kept").count() == 0
    left = pii.find(docs).selectExpr("sum(size(filter(__pii_spans, s -> s.rank < 4)))").first()[0]
    assert left == 0
    last = corpus_pipeline.STAGES[-1][1](spark, docs, DATA)
    assert last.select("doc_id").distinct().count() == sizes[-1]
    assert corpus_pipeline.run(spark, DATA).count() == last.count()


def test_hard_rows_and_empty_tables(spark, docs, empty):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, DATA)
        assert out.columns == docs.columns and 0 < out.count() <= docs.count()
        assert stage(spark, empty, DATA).count() == 0


def test_the_rest_works_without_these_folders(tmp_path):
    for p in ("gridloom", "__spark_entry__.py"):
        (shutil.copytree if (ROOT / p).is_dir() else shutil.copy)(ROOT / p, tmp_path / p)
    shutil.rmtree(tmp_path / "gridloom" / "llm")
    code = "import __spark_entry__ as e; q = e.queries(); assert 'top_sites' in q and not any(k.startswith('op') or k == 'pipeline' for k in q); assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env=os.environ | {"PYTHONPATH": str(tmp_path)})
