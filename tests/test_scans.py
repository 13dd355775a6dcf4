"""Whole-table scans: chunks by a sweep, gaps of timelines, arrays split over tasks."""

import bz2
import json
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from trackmill.operators.grouping import timeline_gaps
from trackmill.operators.joins import sweep_chunks
from trackmill.operators.scans import with_previous
from trackmill.plans import landing_queries
from trackmill.sources import arrays

T = datetime(2024, 1, 1)


def test_sweep_against_every_pair(spark):
    rng = random.Random(1)
    at = lambda: T + timedelta(seconds=rng.randint(0, 4000))
    points = [(i, at()) for i in range(400)] + [(i, T + timedelta(seconds=77)) for i in range(400, 600)] + [(600, None)]
    chunks = [(f"c{i}", *sorted((at(), at()))) for i in range(40)]
    chunks += [("all", T - timedelta(days=1), T + timedelta(seconds=4000)), ("second", T + timedelta(seconds=77), T + timedelta(seconds=78))]
    chunks += [("none", T, T), ("back", T + timedelta(seconds=9), T), ("all", T - timedelta(days=1), T + timedelta(seconds=4000))]
    rows = spark.createDataFrame(points, "id long, ts timestamp_ntz").repartition(5)
    spans = spark.createDataFrame(chunks, "name string, chunk_start timestamp_ntz, chunk_end timestamp_ntz")
    found = sweep_chunks(rows, spans, "ts", ["id"])
    last = max(end for _, start, end in chunks if start < end)
    expected = [
        (i, ts, name, start, end) for i, ts in points for name, start, end in chunks
        if ts and start < end and start <= ts and (ts < end or ts == end == last)
    ]
    assert sorted(tuple(r) for r in found.select("id", "ts", "name", "chunk_start", "chunk_end").collect()) == sorted(expected)
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_sweep_of_nothing(spark):
    rows = spark.createDataFrame([], "id long, ts timestamp_ntz")
    spans = spark.createDataFrame([("a", T, T + timedelta(1))], "name string, chunk_start timestamp_ntz, chunk_end timestamp_ntz")
    assert sweep_chunks(rows, spans, "ts", ["id"]).count() == 0
    some = spark.createDataFrame([(1, T)], "id long, ts timestamp_ntz")
    assert sweep_chunks(some, spans.limit(0), "ts", ["id"]).count() == 0


def test_previous_row_across_ranges(spark):
    rows = [("hot", i, f"v{i}") for i in range(500)] + [(None, i, f"n{i}") for i in range(3)] + [(f"k{i}", 0, "x") for i in range(50)]
    df = spark.createDataFrame(rows, "key string, place long, value string").repartition(7)
    found = with_previous(df, [F.col("key"), F.col("place")], ["value"], ["key"]).collect()
    for row in found:
        before = row["previous"]["value"] if row["previous"] else None
        same = {"hot": "v", None: "n"}.get(row["key"])
        assert before == (f"{same}{row['place'] - 1}" if same and row["place"] else None)


def test_gaps(spark):
    rng = random.Random(2)
    rows = []
    for issue in ("HOT", "A-1", "A-2"):
        value = None
        for i in range(300 if issue == "HOT" else 5):
            before = value if rng.random() < 0.9 else rng.choice(["x", None])
            value = rng.choice(["a", "b", None])
            rows.append((issue, "status", T + timedelta(minutes=i), f"c{i}", before, value))
    df = spark.createDataFrame(rows, "issue_key string, field_name string, change_timestamp timestamp_ntz, change_id string, from_display_value string, to_display_value string")
    expected = [(*b, a[5]) for a, b in zip(rows, rows[1:], strict=False) if a[0] == b[0] and a[5] != b[4]]
    found = timeline_gaps(df.repartition(6), ["change_id"])
    assert sorted(map(tuple, found.collect()), key=str) == sorted(expected, key=str) and expected


# --- arrays ------------------------------------------------------------------

RECORDS = [{"id": i, "text": "a, \"b\" [{" * (i % 3) + "é\\", "list": [{"x": [1, 2, {"y": "}"}]}, []], "none": None} for i in range(60)]


def landed(tmp_path, **files):
    for name, text in files.items():
        (tmp_path / name).write_text(text)
    return str(tmp_path)


def read(spark, path, block):
    return [row["raw_json"] for row in arrays.read_arrays(spark, path, block).collect()]


@pytest.mark.parametrize("block", [300, 5_000, None])
def test_arrays_in_any_layout(spark, tmp_path, block):
    path = landed(
        tmp_path, indented=json.dumps(RECORDS, indent=2), tabs=json.dumps(RECORDS, indent="\t", ensure_ascii=False),
        flat=json.dumps(RECORDS, indent=0), line=json.dumps(RECORDS), close="[" + "}, {".join(["{"] + ['\n"id": 1\n'] * 5 + ["}"]).replace("{}, {", "{", 1).replace("}, {}", "}") + "]",
        empty="[]", blank="",
    )
    found = [json.loads(text) for text in read(spark, path, block)]
    assert [r for r in found if r == {"id": 1}] == [{"id": 1}] * 5
    rest = sorted((r for r in found if r != {"id": 1}), key=lambda r: r["id"])
    assert rest == sorted(RECORDS * 4, key=lambda r: r["id"])


@pytest.mark.parametrize("block", [200, None])
@pytest.mark.parametrize("harm", [
    lambda record: record[:record.rindex("}")], lambda record: record + "}}", lambda record: record.replace('"none"', '"no'),
    lambda record: "[" + record,
])
def test_damage_ends_with_its_record(spark, tmp_path, block, harm):
    texts = ["  " + json.dumps(record, indent=2).replace("\n", "\n  ") for record in RECORDS]
    texts[20] = texts[20][:2] + harm(texts[20][2:]) if not harm("{}").startswith("[") else texts[20] + "[[[{"
    path = landed(tmp_path, harmed="[\n" + ",\n".join(texts) + "\n]")
    good = []
    for text in read(spark, path, block):
        try:
            good.append(json.loads(text)["id"])
        except ValueError:
            assert '"id": 20' in text
    assert sorted(set(range(60)) - set(good)) == [20] or sorted(good) == list(range(60))


def test_one_file_is_read_by_many_tasks(spark, tmp_path):
    path = landed(tmp_path, array=json.dumps(RECORDS, indent=2))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        assert arrays.read_lines(spark, path).rdd.getNumPartitions() >= 8
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert arrays.read_arrays(spark, path, 1000).count() == 60
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
    assert arrays.read_arrays(spark, str(tmp_path / "absent")).count() == 0


def pretty(records, indent="  ", end="\n"):
    texts = [indent + json.dumps(record, indent=2).replace("\n", "\n" + indent) for record in records]
    return ("[\n" + ",\n".join(texts) + "\n]").replace("\n", end)


def test_compressed_arrays_are_read_in_blocks(spark, tmp_path):
    records = [record | {"noise": random.Random(record["id"]).randbytes(20_000).hex()} for record in RECORDS]
    (tmp_path / "array.bz2").write_bytes(bz2.compress(pretty(records).encode(), 1))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        assert arrays.read_lines(spark, str(tmp_path)).rdd.getNumPartitions() >= 8
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted(json.loads(text)["id"] for text in read(spark, str(tmp_path), 100_000)) == list(range(60))


@pytest.mark.parametrize("block", [64, None])
def test_parts_of_files_by_their_own_indentation(spark, tmp_path, block):
    folder = tmp_path / "a folder%20"
    folder.mkdir()
    for name, text in {
        "two": pretty(RECORDS[:5]), "tab": pretty(RECORDS[5:10], "\t"), "lines": pretty(RECORDS[10:15], end="\r\n"),
        "returns": pretty(RECORDS[15:20], end="\r"), "flat": json.dumps(RECORDS[20:25]), "bare": pretty(RECORDS[25:30])[2:-2],
    }.items():
        (folder / name).write_text(text, newline="")
    (folder / "two cut off").write_text(pretty(RECORDS[30:32])[:-2] + ",\n  {")
    found = read(spark, str(folder), block)
    assert [text for text in found if text == "{"] == ["{"]
    assert sorted(json.loads(text)["id"] for text in found if text != "{") == list(range(32))


def test_array_files_are_small_beside_their_text(spark, tmp_path):
    """Neither one task nor plain text; identifiers may repeat."""
    folder = tmp_path / "arrays"
    texts = [json.dumps({"id": str(i), "key": f"A-{i}", "self": f"https://a.example/{i}"}) for i in range(3000)] * 2
    landing_queries.array_files(spark.createDataFrame([(text,) for text in texts], "raw_json string"), str(folder), 3)
    files = list(folder.glob("part-*"))
    assert len(files) == 3 and sum(file.stat().st_size for file in files) * 10 < sum(map(len, texts))
    found = read(spark, str(folder), 20_000)
    assert len(found) == 6001 and len([text for text in found if "last, [of all]" in text]) == 1
    assert sorted(json.loads(text)["id"] for text in found if text.endswith("}") and "last" not in text) == sorted(
        [str(i) for i in range(3000) if i % 1000 != 7] * 2
    )
