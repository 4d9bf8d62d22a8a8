"""A tolerant scan of text files: every listed file gives lines or a failed row, never silence.

Spark's own readers leave out files whose names begin with ``_`` or ``.``
and end a job when a file cannot be read (a truncated gzip member, a file
removed between listing and reading). This scan is a Python data source whose
partitions are byte ranges of the listed files:

* the listing comes from the file system of each path (Hadoop's, through the
  session), recursively and without Spark's name filter, as ``path, bytes``;
* each range is read in its own task. A line belongs to the range in which it
  starts; a compressed file is one range. Besides its lines a task gives one
  accounting row per range: the bytes it read and, if reading failed, why;
* ``failures`` compares, per file, the bytes read over all its ranges with
  the listed length. A difference or an error makes one ``failed`` row for
  the file, and none of its lines are used; other files are not affected.

Reading goes through ``pyarrow.fs``, which knows local, HDFS and object
stores; what it cannot open or name becomes a failed row as well.
"""

from __future__ import annotations

import gzip
import json
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

# Bytes of one range of an uncompressed file.
SPLIT_BYTES = 64 << 20
# Bytes read at a time within a range.
CHUNK = 1 << 20
COMPRESSED = (".gz",)

SCHEMA = "path string, block long, seq long, value string, read_bytes long, error string"


def list_files(spark: SparkSession, paths: list[str]) -> list[tuple[str, int]]:
    """``(path, bytes)`` of every file below ``paths``, names beginning with ``_`` or ``.`` included.

    A path that does not exist lists nothing; the request check reports it.
    """
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    out = []
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        fs = path.getFileSystem(conf)
        if not fs.exists(path):
            continue
        found = fs.listFiles(path, True)
        while found.hasNext():
            status = found.next()
            out.append((status.getPath().toString(), int(status.getLen())))
    return sorted(set(out))


class _Range(InputPartition):
    def __init__(self, path: str, start: int, end: int, listed: int):
        super().__init__((path, start, end, listed))
        self.path, self.start, self.end, self.listed = path, start, end, listed


def _open(path: str, listed: int):
    """The file, refused if its size is no longer the listed one."""
    from pyarrow import fs

    # Hadoop names local files file:/x, unescaped; other stores by their URI.
    if path.startswith("file:"):
        filesystem, inner = fs.LocalFileSystem(), "/" + path[len("file:") :].lstrip("/")
    else:
        filesystem, inner = fs.FileSystem.from_uri(path)
    f = filesystem.open_input_file(inner)
    size = f.size()
    if size != listed:
        f.close()
        raise OSError(f"the file has {size} bytes, {listed} were listed")
    return f


def _lines_of_range(path: str, start: int, end: int, listed: int) -> Iterator[tuple[str | None, int]]:
    """Lines starting in ``[start, end)`` of an uncompressed file, and then ``(None, bytes covered)``.

    Bytes covered are ``end - start`` when the file holds them; a file that
    became shorter covers less, which the accounting sees.
    """
    with _open(path, listed) as f:
        size = f.size()
        stop = min(end, size)
        if start >= stop:
            yield None, 0
            return
        first = max(0, start - 1)
        f.seek(first)
        data = f.read(stop - first)
        if stop < size and not data.endswith(b"\n"):
            # The last line that starts here ends in a later range.
            while True:
                piece = f.read(CHUNK)
                if not piece:
                    break
                cut = piece.find(b"\n")
                data += piece if cut < 0 else piece[: cut + 1]
                if cut >= 0:
                    break
        if start > 0:
            # The line under way at start belongs to the range before.
            cut = data.find(b"\n")
            data = data[cut + 1 :] if cut >= 0 else b""
        lines = data.split(b"\n")
        for line in lines[:-1] if data.endswith(b"\n") or not data else lines:
            yield line.decode("utf-8", "replace"), -1
    yield None, stop - start


class _Reader(DataSourceReader):
    def __init__(self, files: list[tuple[str, int]], split: int):
        self.files, self.split = files, split

    def partitions(self):
        out = []
        for path, size in self.files:
            if path.endswith(COMPRESSED) or size <= self.split:
                out.append(_Range(path, 0, size, size))
            else:
                out.extend(_Range(path, s, min(size, s + self.split), size) for s in range(0, size, self.split))
        return out or [_Range("", 0, 0, 0)]

    def read(self, partition: _Range):
        path, start, end = partition.path, partition.start, partition.end
        if not path:
            return
        seq = 0
        rows = []
        try:
            if path.endswith(COMPRESSED):
                with _open(path, partition.listed) as f:
                    raw = f.read()
                text = gzip.decompress(raw)
                for line in text.split(b"\n")[: -1 if text.endswith(b"\n") else None]:
                    rows.append((path, start, seq, line.decode("utf-8", "replace"), None, None))
                    seq += 1
                rows.append((path, start, seq, None, len(raw), None))
            else:
                for line, covered in _lines_of_range(path, start, end, partition.listed):
                    if line is None:
                        rows.append((path, start, seq, None, covered, None))
                    else:
                        rows.append((path, start, seq, line, None, None))
                    seq += 1
        except (OSError, EOFError, ValueError, zlib.error, gzip.BadGzipFile) as error:
            rows = [(path, start, 0, None, 0, f"{type(error).__name__}: {error}")]
        yield from rows


class TolerantText(DataSource):
    """``spark.read.format("tallyfold_text").option("files", json).load()``: lines and accounting rows."""

    @classmethod
    def name(cls):
        return "tallyfold_text"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return _Reader([tuple(x) for x in json.loads(self.options["files"])], int(self.options.get("split", SPLIT_BYTES)))


def scan_files(spark: SparkSession, files: list[tuple[str, int]], split: int = SPLIT_BYTES) -> DataFrame:
    """Raw rows of the tolerant scan over the listed ``(path, bytes)``: lines (``value`` set) and accounting rows."""
    spark.dataSource.register(TolerantText)
    return spark.read.format("tallyfold_text").option("files", json.dumps(files)).option("split", str(split)).load()


def scan(spark: SparkSession, paths: list[str], split: int = SPLIT_BYTES) -> tuple[DataFrame, list[tuple[str, int]]]:
    """Raw rows over every file below ``paths``, and the listing."""
    files = list_files(spark, paths)
    return scan_files(spark, files, split), files


def checked_lines(
    spark: SparkSession, files: list[tuple[str, int]], split: int = SPLIT_BYTES
) -> tuple[DataFrame, DataFrame]:
    """``(lines, failures)`` of the listed files: ``path, block, seq, value`` and ``path, reason, details``.

    A file fails when a range raised an error or when the bytes read over
    its ranges differ from its listed length (it shrank, grew or vanished).
    Lines of a failed file are left out; an empty file has no lines and no
    failure.
    """
    raw = scan_files(spark, files, split)
    listed = spark.createDataFrame(files or [], "path string, bytes long")
    account = raw.where(F.col("value").isNull()).groupBy("path").agg(
        F.sum("read_bytes").alias("read"), F.max("error").alias("error")
    )
    checked = listed.join(account, "path", "left")
    failed = checked.where(F.col("error").isNotNull() | ~F.col("read").eqNullSafe(F.col("bytes"))).select(
        "path", F.lit("failed").alias("reason"),
        F.coalesce(
            "error",
            F.format_string("read %d of %d bytes", F.coalesce(F.col("read"), F.lit(0)), F.col("bytes")),
        ).alias("details"),
    )
    lines = raw.where(F.col("value").isNotNull()).join(failed.select("path"), "path", "left_anti").select(
        "path", "block", "seq", "value"
    )
    return lines, failed


def tolerant_lines(spark: SparkSession, paths: list[str], split: int = SPLIT_BYTES) -> tuple[DataFrame, DataFrame]:
    """:func:`checked_lines` of every file below ``paths``, names beginning with ``_`` or ``.`` included."""
    return checked_lines(spark, list_files(spark, paths), split)


def documents(lines: DataFrame) -> DataFrame:
    """``path, content``: the lines of each file joined by line feeds, in file order (a file is one row)."""
    ordered = F.array_sort(F.collect_list(F.struct("block", "seq", "value")))
    return lines.groupBy("path").agg(F.array_join(F.transform(ordered, lambda x: x["value"]), "\n").alias("content"))
