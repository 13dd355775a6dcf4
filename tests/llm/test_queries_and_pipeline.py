"""The registered queries against their SQL, and the pipeline against its stages done plainly."""

from pathlib import Path

import oracle
import pytest

import __spark_entry__ as driver
import corpus_pipeline
from trackmill.llm.queries import REGISTRY

SF_DIR = driver.SMOKE_DIR
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables here")

NATIVE = {"op4_fair_mix"}


@pytest.fixture(scope="module")
def connection():
    return oracle.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(name for name, found in REGISTRY.items() if found.sql))
def test_sql(spark, connection, name):
    assert oracle.difference(REGISTRY[name].run(spark, SF_DIR), connection, REGISTRY[name].sql) is None


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_one_row_per_row(spark, connection, name):
    found = REGISTRY[name].run(spark, SF_DIR)
    table = "pages" if "page_id" in found.columns else "embeddings" if "vec_id" in found.columns else "documents"
    if name == "op11_collocations":
        assert found.count() == found.select("lang", "phrase").distinct().count()
    elif name == "op3_decontaminate":
        assert found.count() == found.select("doc_id", "item_id").distinct().count()
    else:
        assert found.count() == spark.read.parquet(f"{SF_DIR}/{table}.parquet").count()


@pytest.mark.parametrize("name", sorted(NATIVE))
def test_native(spark, name):
    text = REGISTRY[name].run(spark, SF_DIR)._jdf.queryExecution().toString()
    for banned in ("Python", "Pandas", "Arrow", "CartesianProduct"):
        assert banned not in text


def test_names():
    assert {name.split("_")[0] for name in REGISTRY} == {f"op{n}" for n in range(1, 14)}
    assert set(driver.queries()) >= set(REGISTRY) | {"pipeline"}


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, kept, SF_DIR).cache()
        assert after.columns == docs.columns, name
        before_ids = {r[0] for r in kept.select("doc_id").collect()}
        assert {r[0] for r in after.select("doc_id").collect()} <= before_ids, name
        kept = after
    told = corpus_pipeline.run(spark, SF_DIR).collect()
    assert sorted(r["doc_id"] for r in told) == sorted(r["doc_id"] for r in kept.collect())
    starts = sorted((r["start"], r["n_tokens"]) for r in told)
    assert [s for s, _ in starts] == [sum(n for _, n in starts[:i]) for i in range(len(starts))]


def test_pipeline_stages_take_odd_and_no_rows(spark, odd_docs, no_docs):
    names = spark.read.parquet(f"{SF_DIR}/documents.parquet").columns
    odd = odd_docs.selectExpr("doc_id", "text", "lang", "source", "length(text) AS n_chars").select(*names)
    for docs in (odd, no_docs.selectExpr("doc_id", "text", "lang", "source", "length(text) AS n_chars").select(*names)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, SF_DIR)
            assert docs.columns == names, name
        corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).count()


SHIPPED = """
import importlib.util, shutil, sys, tempfile
folder = tempfile.mkdtemp()
shutil.copytree("{repo}/trackmill", folder + "/trackmill")
sys.path.insert(0, folder)  # the driver's own copy; workers start without it
from pyspark.sql import SparkSession
from trackmill.llm.queries import REGISTRY
import trackmill
assert trackmill.__file__.startswith(folder)
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config(
    "spark.sql.shuffle.partitions", "2").config("spark.checkpoint.dir", tempfile.mkdtemp()).config(
    "spark.driver.bindAddress", "127.0.0.1").config("spark.driver.host", "127.0.0.1").getOrCreate()
spark.sparkContext.setLogLevel("OFF")
def there(_):
    return [importlib.util.find_spec("trackmill") is not None]
assert not any(spark.sparkContext.parallelize(range(2), 2).mapPartitions(there).collect())
for name, query in REGISTRY.items():
    assert query.run(spark, "{sf}").count() > 0 or name == "op11_collocations", name
print("all ran")
"""


def test_workers_need_no_copy_of_the_library(tmp_path):
    """All queries in a session whose workers cannot import the library."""
    import os
    import subprocess
    import sys

    repo = str(Path(driver.__file__).parent)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", SHIPPED.format(repo=repo, sf=SF_DIR)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900
    )
    assert done.stdout.strip().endswith("all ran"), done.stderr[-3000:]
