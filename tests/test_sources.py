"""Reading files, numbering lines, discovery, history."""

import pytest
from pyspark.sql import functions as F

from tallyfold import session
from tallyfold.functions import text
from tallyfold.schemas import DETAILS
from tallyfold.sources import history as H, lines as L, manifest as M


def test_lines_over_many_splits(spark, tmp_path):
    sizes = {"a.log": 20_000, "b.log": 1, "c.log": 7_000}
    for name, n in sizes.items():
        (tmp_path / name).write_text("\n".join(f"{name} {i} " + "x" * (i % 40) for i in range(1, n + 1)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        raw = L.scan_lines(spark, str(tmp_path))
        assert raw.select("path", "block").distinct().count() > 5
        for limit in (session.BROADCAST_BYTES, 0):
            splits_join = L.join_small
            L.join_small = lambda a, b, on, how: splits_join(a, b, on, how, limit)
            try:
                rows = L.number_lines(raw).select(
                    F.col("line"), F.split("value", " ")[1].cast("bigint").alias("want"), "path"
                )
                assert rows.count() == sum(sizes.values())
                assert rows.where("line <> want").count() == 0
            finally:
                L.join_small = splits_join
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_line_breaks(spark, tmp_path):
    (tmp_path / "a.log").write_bytes(b"one\r\n\ntwo\r\n")
    rows = L.number_lines(L.scan_lines(spark, str(tmp_path), "*.log")).orderBy("line").collect()
    assert [(r["line"], r["value"]) for r in rows] == [(1, "one\r"), (2, ""), (3, "two\r")]


def test_documents(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "a.json").write_text('{\n "a": 1\n}')
    (tmp_path / "b.csv").write_text("x")
    rows = L.scan_documents(spark, str(tmp_path), "*.json").collect()
    assert [r["content"] for r in rows] == ['{\n "a": 1\n}']


def test_manifest(spark, tmp_path):
    (tmp_path / "d").mkdir()
    for name in ("a.csv", "d/b.log", "d/c.JSON", "d/e.txt", "d/f.tar.json"):
        (tmp_path / name).write_text("12345")
    files = M.manifest(spark, str(tmp_path))
    assert files.count() == 5 and {r["bytes"] for r in files.collect()} == {5}
    kept = [r["path"].rsplit("/", 1)[1] for r in M.in_path_order(M.keep_supported(files)).collect()]
    assert kept == ["a.csv", "b.log", "f.tar.json"]
    assert M.dedupe(files.unionByName(files)).count() == 5


def test_discovery_errors(spark):
    files = spark.createDataFrame(
        [("/d/a.csv", 1), ("/d/x/b.txt", 1), ("/d/notes", 1)], "path string, bytes bigint")
    asked = spark.createDataFrame(
        [(p,) for p in ("/d", "/d/a.csv", "/d/a.csv", "/d/x", "/d/x/b.txt", "/d/notes", "/no", "/no.csv")], "input string")
    got = {r["input"]: (r["reason"], r["details"]) for r in M.discovery_errors(asked, files).collect()}
    plain = lambda reason: (reason, DETAILS[reason])
    assert got == {
        "/d/x": plain("no_supported_files"),
        "/d/x/b.txt": ("unsupported_format", "The .txt extension is not supported."),
        "/d/notes": ("unsupported_format", "The  extension is not supported."),
        "/no": plain("directory_not_found"),
        "/no.csv": plain("file_not_found"),
    }


def test_paths_and_text(spark):
    paths = ["/a/b.csv", "b", "/b", "a/b/", "/x/.csv", "/x/a.b.log", "a."]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    rows = df.select(text.base_name(F.col("p")), text.dir_name(F.col("p")), text.extension(F.col("p"))).collect()
    assert [tuple(r) for r in rows] == [
        ("b.csv", "/a", ".csv"), ("b", ".", ""), ("b", "/", ""), ("b", "a", ""), (".csv", "/x", ""),
        ("a.b.log", "/x", ".log"), ("a.", ".", "."),
    ]
    df = spark.createDataFrame([("  id  12:34\t x9  ",)], "m string")
    assert df.select(text.normalize_message(F.col("m"))).first()[0] == "id <num>:<num> x<num>"


def test_history(spark, tmp_path):
    folder = str(tmp_path / "history")
    schema = "id bigint, mode string, total_files int, success_rate double, execution_time_ms double, data string, inserted_at timestamp_ntz"
    row = "SELECT {} AS id, {} AS mode, 8 AS total_files, 75.0D AS success_rate, 32.2D AS execution_time_ms, '{}' AS data, timestamp_ntz'2024-01-0{} 00:00:00' AS inserted_at"
    runs = spark.sql(row.format(1, "'sequential'", '{"counts":{"total":8}}', 1))
    runs = runs.unionByName(spark.sql(row.format(2, "NULL", "{}", 2)))
    H.append(runs, folder)
    H.append(spark.sql(row.format(3, "'parallel'", "{}", 3)), folder)
    stored = H.read(spark, folder)
    assert [f.name for f in spark.createDataFrame([], schema).schema] == stored.columns
    assert [r["id"] for r in H.newest_first(stored).collect()] == [3, 1]
    assert H.get_run(stored, 1).first()["mode"] == "sequential"
    assert H.get_run(stored, 2).count() == 0
    expanded = H.expand(stored, {"total": "$.counts.total:bigint"}).orderBy("id").collect()
    assert [tuple(r) for r in expanded] == [(1, 8), (3, None)]


@pytest.mark.parametrize("limit", [0, 10])
def test_small_join_has_a_way_beyond_the_limit(spark, limit):
    left = spark.range(1000).withColumn("k", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")))
    right = spark.range(5).withColumnRenamed("id", "k")
    got = session.join_small(left, right, "k", "left_anti", limit)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert ("BroadcastHashJoin" in plan) == (limit > 0) or limit == 0
    assert got.count() == left.join(right, "k", "left_anti").count()
