"""Per-document metrics of users and sessions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyfold.functions.once import once
from tallyfold.functions.strict import to_instant
from tallyfold.operators import json_quality as Q
from tallyfold.operators.ranking import top_k
from tallyfold.operators.verdict import arg_max, is_valid

TOP = 5


def user_counts(checked: DataFrame) -> DataFrame:
    """Users of each valid document, 0 where it has none. A document is one row, so nothing is shuffled."""
    active = f"coalesce(try_variant_get(u, '$.{Q.ACTIVE}', 'boolean'), false)"
    counted = once(
        checked.where(is_valid()), ["path"], total="coalesce(size(users), 0)",
        active=f"coalesce(size(filter(users, u -> {active})), 0)",
    )
    return counted.selectExpr(
        "path", "bigint(total) AS total_users", "bigint(active) AS active_users", "bigint(total - active) AS inactive_users"
    )


def session_totals(checked: DataFrame) -> DataFrame:
    """Mean seconds and pages of each valid document's sessions, 0.0 where it has none."""
    total = "aggregate(sessions, 0.0D, (a, s) -> a + {})".format
    summed = once(
        checked.where(is_valid()), ["path"], n="size(sessions)", seconds=total(_number(Q.DURATION)), pages=total(_number(Q.PAGES)),
    )
    return summed.selectExpr(
        "path", "coalesce(try_divide(seconds, n), 0.0D) AS avg_session_seconds", "coalesce(pages, 0.0D) AS total_pages"
    )


def _number(field: str) -> str:
    """A session's number; missing and negative ones are 0."""
    return f"greatest(0.0D, coalesce(try_variant_get(s, '$.{field}', 'double'), 0.0D))"


def _hour(start: str) -> str:
    """UTC hour of a start with an offset; only a string is a start."""
    return f"hour({to_instant(start)})"


def action_counts(actions: DataFrame) -> DataFrame:
    return actions.groupBy("path", "action").agg(F.count(F.lit(1)).alias("n"))


def top_actions(counts: DataFrame) -> DataFrame:
    return top_k(counts, "path", "action", "n", TOP).select("path", "rank", "action", "n")


def peak_hour(checked: DataFrame) -> DataFrame:
    """The hour of each valid document with the most sessions, the earliest on a tie; NULL without any."""
    hours = checked.where(is_valid()).selectExpr(
        "path", f"explode_outer(transform(sessions, s -> {_hour(_START)})) AS hour"
    )
    counts = hours.groupBy("path", "hour").agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy("path").agg(arg_max(F.col("n"), F.col("hour")).alias("best"))
    return best.select("path", F.col("best.key").alias("peak_hour"), (-F.col("best.neg")).alias("peak_sessions"))


_START = f"try_variant_get(s, '$.{Q.START}', 'string')"


def json_facts(checked: DataFrame) -> DataFrame:
    """The one reduction all document results can be derived from.

    ``path, kind, key, n, seconds, pages`` with the kinds ``file`` (its
    verdict), ``user`` (active or not), ``session``, ``hour`` and ``action``.
    A document is parsed once and spread into its verdict, users and sessions;
    each item adds its own few facts. All facts of a document stay in its task
    until the map-side part has counted them, so sums do not depend on the
    cluster, and a single shuffle merges the counts.
    """
    fact = "struct('{}' AS kind, {} AS key, {} AS seconds, {} AS pages)".format
    zero = ("0.0D", "0.0D")
    active = f"coalesce(try_variant_get(u, '$.{Q.ACTIVE}', 'boolean'), false)"
    actions = f"coalesce(try_variant_get(s, '$.{Q.ACTIONS}', 'array<string>'), cast(array() AS array<string>))"
    of_user = f"array({fact('user', f'CAST({active} AS STRING)', *zero)})"
    of_session = f"""concat(
        array({fact("session", "''", _number(Q.DURATION), _number(Q.PAGES))}, {fact("hour", f"CAST({_hour(_START)} AS STRING)", *zero)}),
        transform({actions}, a -> {fact("action", "a", *zero)}))"""
    # An item is the document itself (both parts NULL), a user or a session.
    items = """concat(array(struct(CAST(NULL AS VARIANT) AS u, CAST(NULL AS VARIANT) AS s)),
        transform(coalesce(users, array()), u -> struct(u AS u, CAST(NULL AS VARIANT) AS s)),
        transform(coalesce(sessions, array()), s -> struct(CAST(NULL AS VARIANT) AS u, s AS s)))"""
    spread = checked.selectExpr("path", "verdict", f"inline({items})")
    facts = f"""CASE WHEN u IS NOT NULL THEN {of_user} WHEN s IS NOT NULL THEN {of_session}
                     ELSE array({fact("file", "verdict", *zero)}) END"""
    return (
        spread.selectExpr("path", f"inline({facts})")
        .groupBy("path", "kind", "key")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("seconds").alias("seconds"), F.sum("pages").alias("pages"))
    )


def facts_actions(facts: DataFrame) -> DataFrame:
    return facts.where("kind = 'action'").select("path", F.col("key").alias("action"), "n")


def json_metrics(facts: DataFrame) -> DataFrame:
    """The single-valued metrics, one row per document, from the facts.

    The facts of a document are few (hours, distinct actions), and each sum has
    a map-side part.
    """
    total = lambda test, value="n": F.coalesce(F.sum(F.when(F.expr(test), F.col(value))), F.lit(0))
    hour = F.when((F.col("kind") == "hour") & F.col("key").isNotNull(), F.col("key").cast("int"))
    files = facts.groupBy("path").agg(
        total("kind = 'file' AND key = 'valid'").alias("n_valid"),
        total("kind = 'file' AND key = 'reject'").alias("n_reject"),
        total("kind = 'user'").alias("total_users"),
        total("kind = 'user' AND key = 'true'").alias("active_users"),
        total("kind = 'user' AND key = 'false'").alias("inactive_users"),
        total("kind = 'session'").alias("sessions"),
        total("kind = 'session'", "seconds").cast("double").alias("seconds"),
        total("kind = 'session'", "pages").cast("double").alias("total_pages"),
        arg_max(F.col("n"), hour).alias("best"),
    )
    return files.select(
        "path", (F.col("n_reject") > 0).alias("failed"), "n_valid", "n_reject",
        "total_users", "active_users", "inactive_users",
        F.coalesce(F.try_divide("seconds", "sessions"), F.lit(0.0)).alias("avg_session_seconds"), "total_pages",
        F.col("best.key").alias("peak_hour"), (-F.col("best.neg")).alias("peak_sessions"),
    )
