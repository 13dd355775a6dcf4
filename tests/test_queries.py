"""Every registered query against its SQL on the smallest tables."""

from pathlib import Path

import oracle
import pytest

import __spark_entry__ as driver
from trackmill.plans.registry import REGISTRY

SF_DIR = driver.SMOKE_DIR
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables here")


@pytest.fixture(scope="module")
def connection():
    return oracle.connect(SF_DIR)


def test_entry(spark):
    assert driver.entry(spark).columns == ["project_status", "n", "percent"]


@pytest.mark.parametrize("name", sorted(name for name, query in REGISTRY.items() if query.sql))
def test_query(spark, connection, name):
    result = driver.queries()[name](spark, SF_DIR)
    assert oracle.difference(result, connection, driver.oracle_sql()[name]) is None


def test_streamed_counts_read_a_folder_as_well(spark, tmp_path):
    """The same table as one file and as a folder of part files."""
    spark.read.parquet(f"{SF_DIR}/events.parquet").repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    counts = [driver.queries()["q_t7"](spark, path).collect() for path in (SF_DIR, str(tmp_path))]
    assert counts[0] and sorted(counts[0]) == sorted(counts[1])
