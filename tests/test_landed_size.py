"""What landed documents take on disk, beside their text; every test builds its own tables."""

import json
from collections import Counter
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from trackmill.plans import landing_queries, standins
from trackmill.session import shared_root
from trackmill.sources import arrays

ORDERS = 3000
TABLES = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderpriority string, o_totalprice double, o_orderdate timestamp_ntz",
    "customer": "c_custkey bigint, c_name string, c_mktsegment string, c_acctbal double",
    "lineitem": "l_orderkey bigint, l_shipdate timestamp_ntz",
}


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    """Orders of which every tenth has no line; one is there twice, one has no customer, one no number."""
    folder, day = tmp_path_factory.mktemp("tables"), datetime(1999, 1, 1)
    orders = [(i, i % 50, "OFP"[i % 3], f"{i % 5}-LOW", 1e5 * (i % 4), day + timedelta(days=i % 900)) for i in range(ORDERS)]
    rows = {
        "orders": [*orders, orders[5], (ORDERS, None, "O", None, 1.0, day), (None, 1, "F", None, 1.0, day)],
        "customer": [(i, f"Customer {i}", ("HOUSEHOLD", "TOOLS")[i % 2], float(i % 3 - 1)) for i in range(50)],
        "lineitem": [(i, day + timedelta(days=d)) for i in range(ORDERS) if i % 10 for d in (3, i % 1000)] + [(None, day)],
    }
    for name, schema in TABLES.items():
        spark.createDataFrame(rows[name], schema).write.parquet(str(folder / f"{name}.parquet"))
    return str(folder)


def held(spark) -> int:
    """Bytes in the shared folder."""
    return sum(path.stat().st_size for path in Path(shared_root(spark).removeprefix("file:")).rglob("*") if path.is_file())


def text_of(spark, sf_dir) -> int:
    return standins.issue_documents(spark, sf_dir).agg(F.sum(F.length("raw_json"))).first()[0]


def test_documents_join_orders_lines_and_customers(spark, sf_dir):
    found = [json.loads(row["raw_json"]) for row in standins.issue_documents(spark, sf_dir).collect()]
    assert len(found) == ORDERS + 2 and sum("id" not in document for document in found) == 1
    by_id = {document["id"]: document["fields"] for document in found if "id" in document}
    assert len(by_id) == ORDERS and sum("updated" not in fields for fields in by_id.values()) == ORDERS // 10
    assert by_id["7"]["created"] == "1999-01-08T00:00:00.000+0000" == by_id["7"]["updated"]
    assert by_id["950"].get("updated") is None and by_id["951"]["updated"] == "2001-08-09T00:00:00.000+0000"


def test_pages_are_gathered_where_documents_are_made(spark):
    """Neither kept nor shuffled, full but for the last of a partition, in order, absent ones left out."""
    texts = [json.dumps({"id": i}) if i % 7 else None for i in range(1000)]
    documents = spark.createDataFrame([(text,) for text in texts], "raw_json string").coalesce(1)
    before = held(spark)
    pages = standins.result_pages(documents, 30)
    assert held(spark) == before and "Exchange" not in pages._jdf.queryExecution().executedPlan().toString()
    found = [json.loads(row["value"]) for row in pages.collect()]
    assert [page["startAt"] for page in found] == list(range(0, 1000, 30))
    assert all(page["maxResults"] == 30 and page["total"] == len(page["issues"]) for page in found)
    assert [[issue["id"] for issue in page["issues"]] for page in found] == [
        [i for i in range(start, min(start + 30, 1000)) if i % 7] for start in range(0, 1000, 30)
    ]
    assert standins.result_pages(documents.limit(0), 30).collect() == []


def test_arrays_land_in_a_fraction_of_their_text(spark, sf_dir):
    before = held(spark)
    counts = {row["kind"]: row["n"] for row in driver.queries()["q_s2_array"](spark, sf_dir).collect()}
    assert counts == {"read": ORDERS - ORDERS // 10 + 1, "broken": ORDERS // 10 + 2}
    assert 0 < (held(spark) - before) * 5 < text_of(spark, sf_dir)


def test_array_files_land_in_waves(spark, sf_dir, monkeypatch):
    """Seven files in four waves, of which only the last is still there, plain and read in blocks; every document is judged."""
    for name, value in {"RECORDS": 500, "WAVE": 2, "BLOCK_BYTES": 20_000}.items():
        monkeypatch.setattr(landing_queries, name, value, raising=False)
    scratch = Path(shared_root(spark).removeprefix("file:")) / "scratch"
    there = {*scratch.glob("array-*")} if scratch.exists() else set()
    found = Counter(map(tuple, driver.queries()["q_s2_split"](spark, sf_dir).collect()))
    outcomes = {str(i): "read" if i % 10 else "missing or malformed fields.updated" for i in range(ORDERS)}
    outcomes |= {str(i): "malformed document" for i in range(7, ORDERS, 1000)}
    expected = Counter(outcomes.items()) + Counter([("5", "read"), ("Task", "missing or malformed id"), ('last, [of all] "{', "missing or malformed key")])
    assert found == expected
    landed = [file for path in {*scratch.glob("array-*")} - there for file in path.glob("part-*") if file.suffix != ".parquet"]
    assert len(landed) == 2 and all(file.suffix == ".txt" for file in landed)
    assert sum(file.stat().st_size for file in landed) * 2 < text_of(spark, sf_dir)
    blocks = arrays.read_arrays(spark, str(landed[0].parent), 20_000)
    assert 500 < blocks.count() < 1500


def test_whole_records_are_read_as_by_their_pieces(spark, tmp_path, monkeypatch):
    """One look at a record's text gives what its pieces give, whatever lies in or behind it."""
    deep = '{"a": ' * 9 + "1" + "}" * 9
    bodies = ['{\n    "a" : 1\n  }', '{"a": "}, {\\""}', '{\n\n    "a": 1\n   \n  }  ', '{"a": 1}} ', '{"a": [1}', deep, '{"a": 1} x', '{"a": 1}, {"b": 2}', "{", '{"a": "', "{}\n \n"]
    for name, indent in (("blanks", "  "), ("tab", "\t"), ("both", " \t ")):
        (tmp_path / name).write_text("[\n" + ",\n".join(indent + body for body in bodies) + "\n]")
    found = sorted(row["raw_json"] for row in arrays.read_arrays(spark, str(tmp_path)).collect())
    monkeypatch.setattr(arrays, "WHOLE", r"(?!)()", raising=False)
    assert found == sorted(row["raw_json"] for row in arrays.read_arrays(spark, str(tmp_path)).collect())
    assert found.count('{\n    "a" : 1\n  }') == 1 and found.count('{"a": "}, {\\""}') == 1 and found.count("{}") == 1


def test_readers_may_share_what_they_overwrite(spark, tmp_path):
    """Also for lines of files that do not indent their records."""
    for folder in ("one", "two"):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "indented").write_text(json.dumps([{"id": folder}] * 3, indent=2))
        (tmp_path / folder / "line").write_text(json.dumps([{"id": folder}] * 2))
        found = arrays.read_arrays(spark, str(tmp_path / folder), None, str(tmp_path / "scratch")).collect()
        assert [json.loads(row["raw_json"]) for row in found] == [{"id": folder}] * 5
