"""The tolerant scan: hidden names, failed files as rows, lines equal to Spark's reader over many ranges."""

import gzip
import os

from pyspark.sql import functions as F

from tallyfold.sources import tolerant


def write(folder, name, data: bytes):
    path = os.path.join(folder, name)
    with open(path, "wb") as f:
        f.write(data)
    return path


def test_hidden_and_failed_files(spark, tmp_path):
    folder = str(tmp_path)
    write(folder, "a.csv", b"h\n1\n2\n")
    write(folder, "_b.csv", b"h\n3\n")
    write(folder, ".c.log", b"x\n")
    write(folder, "empty.csv", b"")
    good = gzip.compress(b"g1\ng2\n")
    write(folder, "d.log.gz", good)
    write(folder, "e.log.gz", good[: len(good) // 2])
    lines, failed = tolerant.tolerant_lines(spark, [folder])
    got = sorted((os.path.basename(r.path), r.value) for r in lines.collect())
    assert got == [
        (".c.log", "x"), ("_b.csv", "3"), ("_b.csv", "h"), ("a.csv", "1"), ("a.csv", "2"), ("a.csv", "h"),
        ("d.log.gz", "g1"), ("d.log.gz", "g2"),
    ]
    bad = [(os.path.basename(r.path), r.reason) for r in failed.collect()]
    assert bad == [("e.log.gz", "failed")]


def test_vanished_and_changed_files(spark, tmp_path):
    folder = str(tmp_path)
    write(folder, "a.log", b"1\n2\n")
    gone = write(folder, "b.log", b"3\n")
    grown = write(folder, "c.log", b"4\n")
    raw, files = tolerant.scan(spark, [folder])
    os.remove(gone)
    with open(grown, "ab") as f:
        f.write(b"5\n")
    listed = spark.createDataFrame(files, "path string, bytes long")
    account = raw.where("value IS NULL").groupBy("path").agg(F.max("error").alias("error")).collect()
    errors = {os.path.basename(r.path): r.error for r in account}
    assert errors["a.log"] is None and errors["b.log"] and errors["c.log"]
    assert listed.count() == 3


def test_ranges_equal_spark_reader(spark, tmp_path):
    folder = str(tmp_path)
    body = b"".join(b"line %d %s\n" % (i, b"x" * (i % 37)) for i in range(3000)) + b"last without end"
    write(folder, "big.log", body)
    write(folder, "crlf.log", b"a\r\nb\r\n\n\nc")
    lines, failed = tolerant.tolerant_lines(spark, [folder], split=1000)
    assert failed.count() == 0
    got = sorted((os.path.basename(r.path), r.block, r.seq, r.value) for r in lines.collect())
    mine = {}
    for name, _, _, value in got:
        mine.setdefault(name, []).append(value)
    want = spark.read.option("lineSep", "\n").text(folder).select(F.col("_metadata.file_name").alias("name"), "value")
    theirs = {}
    for r in want.collect():
        theirs.setdefault(r.name, []).append(r.value)
    assert sorted(mine["big.log"]) == sorted(theirs["big.log"]) and len(mine["big.log"]) == 3001
    assert sorted(mine["crlf.log"]) == sorted(theirs["crlf.log"])
    # File order: block, then seq.
    assert [v for n, _, _, v in got if n == "big.log"] == body.decode().split("\n")
