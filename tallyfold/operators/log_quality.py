"""Checks of log lines: ``path, line, value`` in, a checked table out."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyfold import schemas as S
from tallyfold.functions import strict
from tallyfold.functions.once import once
from tallyfold.operators.verdict import REJECT, SKIP, VALID, is_reject, is_valid


# Anything but white space, Unicode white space included.
_TEXT = r"(?U)\S"
# The five groups of a log line; another size where it does not match. The
# line is matched once: the groups are rewritten with line breaks between
# them, which no line contains, and cut apart again.
_GROUPS = rf"split(regexp_replace(value, r'{S.LOG_PATTERN}', '$1\n$2\n$3\n$4\n$5'), '\n', 5)"


def drop_blank(lines: DataFrame) -> DataFrame:
    return lines.where(f"value RLIKE r'{_TEXT}'")


def extract(lines: DataFrame) -> DataFrame:
    """``path, line, day, time, level, component, message``, NULL where the format is wrong."""
    names = ("day", "time", "level", "component", "message")
    return once(lines, ["path", "line"], g=_GROUPS).selectExpr(
        "path", "line", *[f"CASE WHEN size(g) = 5 THEN get(g, {i}) END AS {n}" for i, n in enumerate(names)]
    )


def check_log(lines: DataFrame) -> DataFrame:
    """Every line with its verdict, error and, if valid, typed columns. No shuffle."""
    cut = once(lines, ["path", "line"], blank=f"NOT value RLIKE r'{_TEXT}'", g=_GROUPS)
    at = strict.to_timestamp_ntz("concat(get(g, 0), ' ', get(g, 1))")
    typed = once(cut, ["path", "line", "blank", "g"], ts=f"CASE WHEN size(g) = 5 THEN {at} END")
    error = f"""CASE WHEN blank THEN NULL WHEN size(g) <> 5 THEN '{S.ERR_LOG_FORMAT}'
                     WHEN ts IS NULL THEN '{S.ERR_TIMESTAMP}' END"""
    judged = typed.selectExpr("*", f"{error} AS error").selectExpr(
        "*", f"CASE WHEN blank THEN '{SKIP}' WHEN error IS NOT NULL THEN '{REJECT}' ELSE '{VALID}' END AS verdict"
    )
    kept = {"level": 2, "component": 3, "message": 4}
    return judged.selectExpr(
        "path", "line", "verdict", "error", "false AS fatal", "ts",
        *[f"CASE WHEN verdict = '{VALID}' THEN get(g, {i}) END AS {name}" for name, i in kept.items()],
    )


def valid_entries(checked: DataFrame) -> DataFrame:
    return checked.where(is_valid()).drop("verdict", "error", "fatal")


def log_rejects(checked: DataFrame) -> DataFrame:
    return checked.where(is_reject()).select("path", F.col("line").cast("bigint").alias("line"), "error")


def critical(entries: DataFrame) -> DataFrame:
    return entries.where(F.col("level").isin(*S.CRITICAL_LEVELS))
