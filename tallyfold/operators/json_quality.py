"""Checks of JSON documents: ``path, content`` in, one judged row per document out.

A document is one row, so its checks need no shuffle; users, sessions and
actions are exploded from it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyfold import schemas as S
from tallyfold.functions import strict
from tallyfold.functions.once import once
from tallyfold.operators.verdict import REJECT, VALID, is_valid


# The lists of a document and the fields the metrics read.
USERS, SESSIONS = "usuarios", "sesiones"
ACTIVE, DURATION, PAGES, ACTIONS, START = (
    "activo", "duracion_segundos", "paginas_visitadas", "acciones", "inicio",
)


def parse_documents(docs: DataFrame) -> DataFrame:
    """``path, users, sessions, keys, error``: strict JSON with an object at the root.

    A bare parse ignores text after the first value. So the text is read as
    the first of two elements, followed by a hash of itself: only if the text
    is exactly one value is the array's second and last element that hash.
    The reading is a stream in which only the items of the two lists become
    values, so no limit applies to the size of a document.
    """
    schema = f"ARRAY<STRUCT<{USERS}: ARRAY<VARIANT>, {SESSIONS}: ARRAY<VARIANT>, seal: BIGINT>>"
    sealed = "concat('[', content, ',{\"seal\":', xxhash64(content), '}]')"
    strict_json = "map('allowSingleQuotes', 'false', 'allowNonNumericNumbers', 'false')"
    # A root of another kind only has to be told from malformed text.
    other = "concat('[{\"root\":', content, '},{\"seal\":', xxhash64(content), '}]')"
    rooted = once(docs, ["path", "content"], seal="xxhash64(content)", object=r"content RLIKE r'\A\s*\{'")
    boxed = once(
        rooted, ["path", "content", "seal", "object"],
        boxed=f"""CASE WHEN object THEN from_json({sealed}, '{schema}', {strict_json})
                       ELSE from_json({other}, '{schema}', {strict_json}) END""",
    )
    # An empty text leaves the seal as the only element.
    whole = "coalesce(size(boxed) = 2 AND get(boxed, 1).seal = seal, false)"
    # The keys tell a list that is not there from one that is no list.
    missing = f"get(boxed, 0).{USERS} IS NULL OR get(boxed, 0).{SESSIONS} IS NULL"
    return once(
        boxed, ["path"],
        error=f"""CASE WHEN NOT {whole} THEN '{S.ERR_JSON}'
                       WHEN NOT object THEN '{S.ERR_JSON_ROOT}' END""",
        users=f"CASE WHEN {whole} THEN get(boxed, 0).{USERS} END",
        sessions=f"CASE WHEN {whole} THEN get(boxed, 0).{SESSIONS} END",
        keys=f"CASE WHEN {whole} AND ({missing}) THEN json_object_keys(content) END",
    )


def _type(value: str, field: str) -> str:
    """The type name of a field; NULL where it is missing."""
    return f"schema_of_variant(try_variant_get({value}, '$.{field}', 'variant'))"


def _some(items: str, test: str) -> str:
    """Some item ``x`` passes the test."""
    return f"coalesce(exists({items}, x -> {test}), false)"


def _no_number(kind: str) -> str:
    return f"NOT ({kind} IN ('BIGINT', 'DOUBLE', 'FLOAT') OR startswith({kind}, 'DECIMAL'))"


def find_violations(parsed: DataFrame) -> DataFrame:
    """Add ``violation``: the first field whose type the metrics cannot read."""
    no_object = "NOT startswith(schema_of_variant(x), 'OBJECT')"
    checks = [
        (USERS, f"users IS NULL AND coalesce(array_contains(keys, '{USERS}'), false)"),
        (SESSIONS, f"sessions IS NULL AND coalesce(array_contains(keys, '{SESSIONS}'), false)"),
        (USERS, _some("users", no_object)),
        (SESSIONS, _some("sessions", no_object)),
        (ACTIVE, _some("users", f"{_type('x', ACTIVE)} <> 'BOOLEAN'")),
        (DURATION, _some("sessions", _no_number(_type("x", DURATION)))),
        (PAGES, _some("sessions", _no_number(_type("x", PAGES)))),
        (ACTIONS, _some("sessions", f"NOT startswith({_type('x', ACTIONS)}, 'ARRAY')")),
    ]
    found = " ".join(f"WHEN {test} THEN '{name}'" for name, test in checks)
    return once(parsed, ["path", "error", "users", "sessions"], violation=f"CASE {found} END")


def check_documents(docs: DataFrame) -> DataFrame:
    """One row per document: verdict, error and the lists of users and sessions."""
    judged = find_violations(parse_documents(docs)).selectExpr(
        "path", "users", "sessions", "coalesce(error, 'type violation: ' || violation) AS error"
    )
    return judged.selectExpr(
        "path",
        f"CASE WHEN error IS NULL THEN '{VALID}' ELSE '{REJECT}' END AS verdict",
        "error",
        "error IS NOT NULL AS fatal",
        "CASE WHEN error IS NULL THEN users END AS users",
        "CASE WHEN error IS NULL THEN sessions END AS sessions",
    )


def json_errors(checked: DataFrame) -> DataFrame:
    return checked.where("error IS NOT NULL").select("path", "error")


def users(checked: DataFrame) -> DataFrame:
    """One row per user: ``path, active`` and the fields carried through."""
    rows = checked.where(is_valid()).selectExpr("path", "explode(users) AS u")
    return rows.selectExpr(
        "path",
        "try_variant_get(u, '$.id', 'bigint') AS user_id",
        "try_variant_get(u, '$.nombre', 'string') AS name",
        "try_variant_get(u, '$.email', 'string') AS email",
        f"coalesce(try_variant_get(u, '$.{ACTIVE}', 'boolean'), false) AS active",
        "try_variant_get(u, '$.ultimo_acceso', 'string') AS last_access",
    )


def sessions(checked: DataFrame) -> DataFrame:
    """One row per session; missing or negative numbers are 0."""
    rows = checked.where(is_valid()).selectExpr("path", "explode(sessions) AS s")
    number = "greatest(0.0D, coalesce(try_variant_get(s, '$.{}', 'double'), 0.0D)) AS {}"
    return rows.selectExpr(
        "path",
        "try_variant_get(s, '$.usuario_id', 'bigint') AS user_id",
        # A start that is not a string is ignored.
        f"CASE WHEN {_type('s', START)} = 'STRING' THEN try_variant_get(s, '$.{START}', 'string') END AS start",
        number.format(DURATION, "seconds"),
        number.format(PAGES, "pages"),
        f"coalesce(try_variant_get(s, '$.{ACTIONS}', 'array<string>'), cast(array() AS array<string>)) AS actions",
    )


def actions(session_rows: DataFrame) -> DataFrame:
    return session_rows.select("path", F.explode("actions").alias("action"))


def session_hours(session_rows: DataFrame) -> DataFrame:
    """UTC hour of each session whose start has an offset; others are left out."""
    at = once(session_rows, ["path"], at=strict.to_instant("start"))
    return at.where("at IS NOT NULL").selectExpr("path", "hour(at) AS hour")
