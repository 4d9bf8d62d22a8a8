"""Document checks and metrics."""

import json

import pytest

from tallyfold import schemas as S
from tallyfold.operators import json_metrics as JM, json_quality as JQ


def checked(spark, docs):
    return JQ.check_documents(spark.createDataFrame(list(docs.items()), "path string, content string"))


SESSION = {"usuario_id": 1, "inicio": "2024-02-27T10:15:00Z", "duracion_segundos": 60, "paginas_visitadas": 3,
           "acciones": ["login", "logout"]}


def test_validity(spark):
    cases = {
        "{}": None,
        ' {"usuarios": []}\n': None,
        '{"a": 1, "a": 2}': None,
        "": S.ERR_JSON,
        "{": S.ERR_JSON,
        '{"a":1} // c': S.ERR_JSON,
        '{"a":1}{"b":2}': S.ERR_JSON,
        '{"a":1},{"b":2}': S.ERR_JSON,
        '{"a":1},': S.ERR_JSON,
        "1],[2": S.ERR_JSON,
        '{"a":1}] x': S.ERR_JSON,
        '{"a":1},0]': S.ERR_JSON,
        "{a:1}": S.ERR_JSON,
        "[]": S.ERR_JSON_ROOT,
        '[{"a":1}]': S.ERR_JSON_ROOT,
        "null": S.ERR_JSON_ROOT,
        "": S.ERR_JSON,
        '{"a":1},"seal":5': S.ERR_JSON,
        '{"a":1},{"b":2}': S.ERR_JSON,
        "[1": S.ERR_JSON,
        "{'a':1}": S.ERR_JSON,
        '{"a":NaN}': S.ERR_JSON,
        '{"a":01}': S.ERR_JSON,
        "1": S.ERR_JSON_ROOT,
        '"x"': S.ERR_JSON_ROOT,
        '{"usuarios": null}': "type violation: usuarios",
        '{"usuarios": {}}': "type violation: usuarios",
        '{"usuarios": [1]}': "type violation: usuarios",
        '{"usuarios": [{"activo": null}]}': "type violation: activo",
        '{"usuarios": [{"activo": true}, {"activo": "si"}]}': "type violation: activo",
        '{"sesiones": "x"}': "type violation: sesiones",
        '{"sesiones": [[]]}': "type violation: sesiones",
        '{"sesiones": [{"duracion_segundos": "9"}]}': "type violation: duracion_segundos",
        '{"sesiones": [{"duracion_segundos": null}]}': "type violation: duracion_segundos",
        '{"sesiones": [{"paginas_visitadas": true}]}': "type violation: paginas_visitadas",
        '{"sesiones": [{"acciones": null}]}': "type violation: acciones",
        '{"sesiones": [{"duracion_segundos": 1.5, "paginas_visitadas": 1e2, "inicio": 5}]}': None,
    }
    docs = {f"{i}.json": text for i, text in enumerate(cases)}
    got = {r["path"]: r["error"] for r in checked(spark, docs).collect()}
    assert [got[f"{i}.json"] for i in range(len(cases))] == list(cases.values())


def test_metrics(spark):
    docs = {
        "a.json": json.dumps({
            "usuarios": [{"activo": True}, {"activo": False}, {}],
            "sesiones": [
                SESSION,
                {**SESSION, "inicio": "2024-02-27T10:15:00+02:00", "duracion_segundos": -5, "paginas_visitadas": -1},
                {**SESSION, "inicio": "2024-02-27T10:15:00", "acciones": ["view", "login"]},
                {"inicio": "2024-02-27T08:00:00.25-0030"},
                {"inicio": 5, "acciones": []},
            ],
        }),
        "none.json": "{}",
        "bad.json": "[",
    }
    rows = checked(spark, docs)
    facts = JM.json_facts(rows)
    got = {r["path"]: r.asDict() for r in JM.json_metrics(facts).collect()}
    a = got["a.json"]
    assert (a["total_users"], a["active_users"], a["inactive_users"]) == (3, 1, 2)
    assert a["avg_session_seconds"] == pytest.approx(24.0)
    assert a["total_pages"] == 6.0
    # 10 and 8 UTC twice each is a tie only if both count: 10:15Z, 08:15Z, 08:30Z.
    assert (a["peak_hour"], a["peak_sessions"]) == (8, 2)
    none = got["none.json"]
    assert (none["failed"], none["total_users"], none["avg_session_seconds"], none["peak_hour"]) == (False, 0, 0.0, None)
    assert got["bad.json"]["failed"] and got["bad.json"]["n_reject"] == 1
    top = JM.top_actions(JM.facts_actions(facts)).orderBy("rank").collect()
    assert [(r["action"], r["n"]) for r in top] == [("login", 3), ("logout", 2), ("view", 1)]
    # The exploded rows give the same.
    sessions = JQ.sessions(rows)
    by = lambda df: {r["path"]: tuple(r)[1:] for r in df.collect()}
    assert by(JM.session_totals(rows)) == {"a.json": (pytest.approx(24.0), 6.0), "none.json": (0.0, 0.0)}
    assert by(JM.peak_hour(rows)) == {"a.json": (8, 2), "none.json": (None, None)}
    assert by(JM.user_counts(rows)) == {"a.json": (3, 1, 2), "none.json": (0, 0, 0)}
    direct = JM.top_actions(JM.action_counts(JQ.actions(sessions)))
    assert sorted(map(tuple, direct.collect())) == sorted(map(tuple, top))


def test_documents_have_no_size_limit(spark):
    """A valid document of 180 MB is valid and counted; a single value could not hold it."""
    user = '{"activo":true,"nombre":"' + "x" * 180 + '"}'
    n = 900_000
    docs = spark.createDataFrame([("big.json", n)], "path string, n int").selectExpr(
        "path", f"""concat('{{"usuarios":[', array_join(array_repeat('{user}', n), ','), ']}}') AS content""")
    row = JM.user_counts(JQ.check_documents(docs)).first()
    assert (row["path"], row["total_users"], row["active_users"]) == ("big.json", n, n)
