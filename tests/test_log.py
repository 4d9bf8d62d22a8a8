"""Row checks and metrics of logs."""

import random
from datetime import datetime, timedelta

from tallyfold import schemas as S
from tallyfold.operators import log_metrics as LM, log_quality as LQ, rollup as R


def lines(spark, files):
    rows = [(path, i, v) for path, values in files.items() for i, v in enumerate(values, start=1)]
    return spark.createDataFrame(rows, "path string, line bigint, value string")


CASES = {
    "2024-02-28 08:30:45 [ERROR] [Store] a b": (None, "a b"),
    "2024-02-28\t08:30:45   [X]  [a [b]  m ": (None, "m "),
    "2024-02-28 08:30:45 [INFO] [a] ": (None, ""),
    "2024-02-28 08:30:45 [INFO] [a] m\r": (None, "m\r"),
    "2024-02-28 08:30:45 [INFO] [a]": (S.ERR_LOG_FORMAT, None),
    "2024-02-28 08:30:45 [info] [a] m": (S.ERR_LOG_FORMAT, None),
    "2024-02-28 08:30:45 [INFO] [] m": (S.ERR_LOG_FORMAT, None),
    " 2024-02-28 08:30:45 [INFO] [a] m": (S.ERR_LOG_FORMAT, None),
    "2024-2-28 08:30:45 [INFO] [a] m": (S.ERR_LOG_FORMAT, None),
    "2024-02-30 08:30:45 [INFO] [a] m": (S.ERR_TIMESTAMP, None),
    "2024-02-28 24:00:00 [INFO] [a] m": (S.ERR_TIMESTAMP, None),
    "2024-02-28 23:59:60 [INFO] [a] m": (S.ERR_TIMESTAMP, None),
}


def test_lines(spark):
    rows = LQ.check_log(lines(spark, {"a.log": list(CASES)})).orderBy("line").collect()
    assert [(r["error"], r["message"]) for r in rows] == list(CASES.values())


def test_blank_lines_are_numbered_but_skipped(spark):
    checked = LQ.check_log(lines(spark, {"a.log": ["", " \t", "  ", "oops"], "b.log": ["", " "]}))
    assert [(r["line"], r["error"]) for r in LQ.log_rejects(checked).collect()] == [(4, S.ERR_LOG_FORMAT)]
    status = {r["path"]: r["status"] for r in R.file_status(R.line_counts(checked), "log").collect()}
    assert status == {"a.log": "failed", "b.log": "ok"}
    assert LQ.drop_blank(lines(spark, {"a.log": ["", " ", "x"]})).count() == 1


def entry(ts, level, message="m", component="c"):
    return f"{ts:%Y-%m-%d %H:%M:%S} [{level}] [{component}] {message}"


def gaps(times):
    times = sorted(times)
    steps = [int((b - a).total_seconds()) for a, b in zip(times, times[1:])]
    if not steps:
        return (0, 0.0, None, None)
    return (len(steps), sum(steps) / len(steps), min(steps), max(steps))


def test_gaps_match_brute_force(spark):
    rnd = random.Random(7)
    start = datetime(2024, 2, 27, 22, 0, 0)
    files = {
        "same.log": [start] * 5,
        "one.log": [start],
        "month.log": [datetime(2024, 1, 31, 23, 59, 59), datetime(2024, 2, 1, 0, 0, 1), datetime(2023, 12, 1)],
        "many.log": [start + timedelta(seconds=rnd.randrange(400_000)) for _ in range(900)],
        "sparse.log": [start + timedelta(days=rnd.randrange(900), seconds=rnd.randrange(86_400)) for _ in range(60)],
    }
    text = {}
    for path, times in files.items():
        text[path] = [entry(t, rnd.choice(["ERROR", "FATAL"])) for t in times] + [entry(start, "INFO")]
        rnd.shuffle(text[path])
    checked = LQ.check_log(lines(spark, text))
    direct = LM.error_gaps(LM.second_counts(checked))
    from_facts = LM.error_gaps(LM.facts_seconds(LM.log_facts(checked)))
    for result in (direct, from_facts):
        got = {r["path"]: (r["gap_count"], r["gap_avg"], r["gap_min"], r["gap_max"]) for r in result.collect()}
        assert {p: (g[0], round(g[1], 9), g[2], g[3]) for p, g in got.items()} == {
            p: (g[0], round(g[1], 9), g[2], g[3]) for p, g in ((p, gaps(t)) for p, t in files.items())
        }


def test_patterns_and_ties(spark):
    at = datetime(2024, 1, 1)
    messages = {
        "twice.log": ["id 1  x", "id 22 x", "b", "a"],
        "once.log": ["b 1", "a 1"],
        "none.log": [],
        "seven.log": [w for w in "gfedcba" for _ in range(2)],
    }
    text = {p: [entry(at, "ERROR", m) for m in ms] + [entry(at, "WARN", "w")] for p, ms in messages.items()}
    facts = LM.log_facts(LQ.check_log(lines(spark, text)))
    got: dict = {}
    for r in LM.patterns(LM.facts_messages(facts)).orderBy("path", "rank").collect():
        got.setdefault(r["path"], []).append((r["pattern"], r["n"]))
    assert got == {
        "twice.log": [("id <num> x", 2)], "once.log": [("a <num>", 1)], "seven.log": [(w, 2) for w in "abcde"],
    }
    top: dict = {}
    for r in LM.top_errors(LM.facts_messages(facts)).orderBy("path", "rank").collect():
        top.setdefault(r["path"], []).append(r["message"])
    assert top["twice.log"] == ["a", "b", "id 1  x", "id 22 x"]
    assert top["seven.log"] == list("abcde")


def test_facts_agree_with_single_metrics(spark):
    rnd = random.Random(3)
    at = datetime(2024, 5, 1)
    text = {
        f"{i}.log": [
            entry(at + timedelta(minutes=rnd.randrange(3000)), rnd.choice(["INFO", "ERROR", "FATAL", "ODD"]),
                  f"m {rnd.randrange(4)}", f"c{rnd.randrange(3)}")
            for _ in range(200)
        ] + ["broken"] * (i % 2)
        for i in range(4)
    }
    checked = LQ.check_log(lines(spark, text))
    entries, facts = LQ.valid_entries(checked), LM.log_facts(checked)
    same = lambda a, b: sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    assert same(LM.by_level(entries), LM.facts_by_level(facts))
    assert same(LM.by_hour(entries), LM.facts_by_hour(facts))
    assert same(LM.message_counts(entries), LM.facts_messages(facts))
    metrics = LM.log_metrics(facts)
    assert same(LM.total_entries(checked), metrics.select("path", "total_entries"))
    assert same(LM.top_component(checked), metrics.select("path", "top_component", "top_component_errors"))
    totals = {r["level"]: r["n"] for r in R.log_totals(facts).collect()}
    assert sum(totals.values()) == 400


def test_top_k_limits_before_the_shuffle(spark):
    """A hot file sends at most five rows per task to its ranking."""
    checked = LQ.check_log(lines(spark, {"a.log": [entry(datetime(2024, 1, 1), "ERROR", f"m{i}") for i in range(50)]}))
    top = LM.top_errors(LM.message_counts(LQ.valid_entries(checked)))
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_files_without_entries_have_rows(spark):
    checked = LQ.check_log(lines(spark, {"quiet.log": [entry(datetime(2024, 1, 1), "INFO")], "broken.log": ["x", ""]}))
    by = lambda df: {r["path"]: tuple(r)[1:] for r in df.collect()}
    assert by(LM.total_entries(checked)) == {"quiet.log": (1,), "broken.log": (0,)}
    assert by(LM.top_component(checked)) == {"quiet.log": (None, None), "broken.log": (None, None)}
    assert by(LM.error_gaps(LM.second_counts(checked))) == {p: (0, 0.0, None, None) for p in ("quiet.log", "broken.log")}
