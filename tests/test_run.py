"""Whole runs over files on disk."""

import pytest

from tallyfold.plans.run import run, stored_run
from tallyfold.schemas import DETAILS, SALES_HEADER

LOG = """2024-02-28 08:00:00 [INFO] [Web] started
2024-02-28 08:30:00 [ERROR] [Db] lost 12 rows

2024-02-28 09:00:30 [FATAL] [Db] lost 7 rows
"""
DOC = """{"usuarios": [{"activo": true}, {"activo": false}],
 "sesiones": [{"inicio": "2024-02-27T23:15:00-02:00", "duracion_segundos": 90, "paginas_visitadas": 4,
               "acciones": ["login", "view", "login"]}]}"""


@pytest.fixture()
def data(tmp_path):
    folder = tmp_path / "in" / "day one"
    folder.mkdir(parents=True)
    (folder / "ok.csv").write_text(
        SALES_HEADER + '\n2024-01-02,Pen 7",Office,10.0,3,50\n2024-01-09,Cup,Home,2.5,1,0')
    (folder / "part.csv").write_text(SALES_HEADER + "\n2024-01-02,Pen,Office,1,1,0\nx\n2024-01-02,Pen,Office,1,y,0\n")
    (folder / "empty.csv").write_text("")
    (folder / "a.log").write_text(LOG)
    (folder / "empty.log").write_text("")
    (folder / "a.json").write_text(DOC)
    (folder / "bad.json").write_text("{")
    (folder / "notes.txt").write_text("x")
    return tmp_path


def test_report(spark, data):
    out, history = str(data / "out"), str(data / "history")
    folder = str(data / "in")
    result = run(spark, [folder, folder + "/day one/ok.csv", folder], out, "sequential", history)
    assert result.ok and result.errors == []
    assert result.summary == {
        "total": 7, "ok": 4, "failed": 3, "csv": 3, "json": 2, "log": 2, "success_rate": pytest.approx(400 / 7)}
    text = "\n".join(r[0] for r in spark.read.text(out + "/report").collect())
    for part in (
        "FILE PROCESSING REPORT", "Processing mode: sequential", "Total files processed: 7", "Files with errors: 3",
        "Success rate: 57.1%", "CSV FILE METRICS",
        "[File: ok.csv]\n  * Total sales: $17.5\n  * Unique products: 2\n  * Best-selling product: Pen 7 (3 units)\n"
        "  * Highest-revenue category: Office ($15.0)\n  * Average discount applied: 25.0%\n"
        "  * Period: 2024-01-02 to 2024-01-09",
        "Omitted files (errors were found):\n  - empty.csv (failed): line 1: Empty CSV\n"
        "  - part.csv (partial): line 3: Row must have 6 columns",
        "Consolidated CSV totals:\n  - Total sales: $17.5\n  - Total unique products: 2",
        "  * Average session duration: 1.5 minutes\n  * Total pages visited: 4\n  * Top actions:\n"
        "    1. login (2 times)\n    2. view (1 times)\n  * Peak activity hour: 1:00 (1 sessions)",
        "  - bad.json (failed): See the errors section for more details",
        "  - Total users (sum): 2\n  - Active (sum): 1\n  - Inactive (sum): 1",
        "  * Total entries: 3\n  * Level distribution: ERROR=1, FATAL=1, INFO=1\n"
        "  * Components with most errors: Db (2 errors)\n  * Time distribution (by hour): 8=2, 9=1\n"
        "  * Most frequent errors:\n    1. lost 12 rows (1)\n    2. lost 7 rows (1)\n"
        "  * Time between critical errors (sec): avg=1830.0, min=1830, max=1830, n=1\n"
        "  * Recurring error patterns:\n    1. lost <num> rows (2)",
        "[File: empty.log]\n  * Total entries: 0\n  * Level distribution: N/A",
        "  - Total entries: 3\n  - Level distribution: ERROR=1, FATAL=1, INFO=1",
        "ERRORS AND WARNINGS", "part.csv: partial: line 4: Invalid quantity", "bad.json: JSON decode error",
        "END OF REPORT",
    ):
        assert part in text, part
    assert text.index("part.csv: partial: line 3") < text.index("part.csv: partial: line 4")
    stored = spark.read.parquet(history).first()
    assert (stored["mode"], stored["total_files"]) == ("sequential", 7)


def test_errors_that_stop_a_run(spark, data, tmp_path):
    out = str(tmp_path / "out")
    only_bad = data / "bad"
    only_bad.mkdir()
    (only_bad / "a.json").write_text("[]")
    empty = data / "void"
    empty.mkdir()
    one = lambda inputs: run(spark, inputs, out).errors
    plain = lambda path, reason, **v: [{"path": path, "reason": reason, "details": DETAILS[reason].format(**v)}]
    assert one(str(only_bad)) == plain("run", "no_successful_files", total=1, ok=0)
    assert one(str(empty)) == plain(str(empty), "no_supported_files")
    txt = str(data / "in" / "day one" / "notes.txt")
    assert one(txt) == plain(txt, "unsupported_format", ext=".txt")
    assert one("absent.csv") == plain("absent.csv", "file_not_found")
    assert one("absent/folder") == plain("absent/folder", "directory_not_found")
    assert one(5) == plain("", "argument_malformed")
    assert run(spark, "x", out, "fast").errors == plain("mode", "invalid_mode", mode='"fast"')
    # Errors are all that was written.
    import os

    assert os.listdir(out) == ["errors"]


def files_below(folder):
    return sorted(str(p.relative_to(folder)) for p in folder.rglob("*.parquet")) if folder.exists() else []


def test_clean_runs_keep_their_tables(spark, tmp_path):
    """Files without any fault, relative and with pattern signs in their names, twice."""
    folder = tmp_path / "in [1]"
    folder.mkdir()
    (folder / "h[1].csv").write_text(SALES_HEADER + "\n2024-01-02,Pen,Office,10.0,3,50")
    (folder / "a.log").write_text(LOG)
    (folder / "a.json").write_text(DOC)
    (folder / "b1.csv").write_text(SALES_HEADER + "\n2024-01-02,Ink,Office,1.0,1,0")
    out, history = tmp_path / "out", str(tmp_path / "history")
    first = run(spark, str(folder), str(out), history_dir=history)
    assert first.ok and first.errors == [] and first.summary["ok"] == first.summary["total"] == 4
    text = "\n".join(r[0] for r in spark.read.text(str(out / "report")).collect())
    assert "No global errors." in text and "Success rate: 100.0%" in text
    assert first.tables["errors"].count() == 0
    second = run(spark, str(folder / "h[1].csv"), str(out), history_dir=history)
    assert second.ok and second.summary["total"] == 1
    # The tables of both runs are there and are read back from the history.
    runs = {r["total_files"]: r for r in spark.read.parquet(history).collect()}
    assert set(runs) == {1, 4}
    data, tables = stored_run(spark, history, runs[4]["id"])
    assert data["csv_totals"] == {"total_sales": 16.0, "unique_products": 2} and data["counts"] == first.summary
    assert data["json_totals"]["total_users"] == 2 and data["log_totals"] == {"entries": 3}
    assert tables["file_status"].count() == 4 and tables["csv_metrics"].count() == 2
    _, tables = stored_run(spark, history, runs[1]["id"])
    assert [r["total_sales"] for r in tables["csv_metrics"].collect()] == [15.0]


def test_refused_runs_write_their_errors(spark, tmp_path):
    out, bad = str(tmp_path / "out"), tmp_path / "bad"
    bad.mkdir()
    (bad / "a.json").write_text("[]")
    assert not run(spark, ["absent.csv", str(tmp_path / "gone")], out).ok
    assert not run(spark, str(bad), out).ok
    errors = spark.read.parquet(out + "/errors").collect()
    assert {(r["reason"], r["details"]) for r in errors} == {
        ("file_not_found", DETAILS["file_not_found"]), ("directory_not_found", DETAILS["directory_not_found"]),
        ("failed", "JSON root must be an object"),
    }
    assert len({r["run_id"] for r in errors}) == 2 and all(r["run_ts"] for r in errors)
    assert not files_below(tmp_path / "out" / "runs")


def test_wholly_failed_and_clean_files(spark, tmp_path):
    """A file that fails line by line is in no error list, but omitted."""
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "ok.csv").write_text(SALES_HEADER + "\n2024-01-02,Pen,Office,10.0,3,50")
    (folder / "no.csv").write_text(SALES_HEADER + "\nx")
    result = run(spark, str(folder), str(tmp_path / "out"))
    assert result.ok and result.summary["ok"] == 1 and result.tables["errors"].count() == 0
    assert [r["message"] for r in result.tables["omitted_files"].collect()] == ["line 2: Row must have 6 columns"]


def test_hidden_and_unreadable_files(spark, tmp_path, monkeypatch):
    """A file named _b.csv is read; a file that changed after listing fails with a row, the others are processed."""
    from tallyfold.plans import run as R
    from tallyfold.sources import tolerant

    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text(SALES_HEADER + "\n2024-01-02,Pen,Office,10.0,3,50")
    (folder / "_b.csv").write_text(SALES_HEADER + "\n2024-01-02,Ink,Office,1.0,1,0")
    (folder / "c.log").write_text(LOG)
    listing = tolerant.list_files

    def changed(spark, paths):
        return [(p, n + 1 if p.endswith("c.log") else n) for p, n in listing(spark, paths)]

    monkeypatch.setattr(R.T, "list_files", changed)
    result = run(spark, str(folder), str(tmp_path / "out"))
    status = {r["path"].rsplit("/", 1)[-1]: r["status"] for r in result.tables["file_status"].collect()}
    assert status == {"a.csv": "ok", "_b.csv": "ok", "c.log": "failed"}
    errors = [(r["path"].rsplit("/", 1)[-1], r["error"]) for r in result.tables["file_errors"].collect()]
    assert [p for p, _ in errors] == ["c.log"] and errors[0][1].startswith("read_failed: ")
    assert result.tables["csv_totals"].first()["unique_products"] == 2
