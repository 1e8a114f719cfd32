from tickloom.operators.bodies import json_bodies, text_bodies
from tickloom.sources.landing import landed_bodies

SCHEMA = "response_id string, status int, reason string, body string"
ROWS = [("a", 200, "OK", '{"k": 1}'), ("b", 422, "Unprocessable", '{"k": 2}'), ("c", 500, "Server Error", "{}"),
        ("d", 200, "OK", '{"k": '), ("e", None, "no response: timed out", None), ("f", 200, "OK", "null")]


def frame(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def reasons(errors):
    return {r.response_id: r.reason for r in errors.collect()}


def test_text(spark):
    found = text_bodies(frame(spark))
    assert {r.response_id for r in found.bodies.collect()} == {"a", "b", "d", "f"}
    assert reasons(found.errors) == {"c": "status 500 Server Error", "e": "no response: timed out"}


def test_json(spark):
    found = json_bodies(frame(spark))
    values = {r[0]: r[1] for r in found.bodies.selectExpr(
        "response_id", "try_variant_get(json, '$.k', 'bigint')").collect()}
    assert values == {"a": 1, "b": 2, "f": None}
    assert reasons(found.errors)["d"] == "bad json"


def test_json_with_schema(spark):
    found = json_bodies(frame(spark), schema="k bigint")
    assert {r.response_id: r.k for r in found.bodies.select("response_id", "json.k").collect()} \
        == {"a": 1, "b": 2, "f": None}


def test_files_are_whole_bodies(spark, tmp_path):
    text = "line 1\nline 2 é\n" * 1000
    (tmp_path / "page.html").write_text(text)
    (tmp_path / "data.json").write_text('{"k":\n 3}')
    bodies = landed_bodies(spark, str(tmp_path))
    assert {r.body for r in text_bodies(bodies).bodies.collect()} == {text, '{"k":\n 3}'}
    assert json_bodies(bodies, schema="k bigint").bodies.select("json.k").collect() == [(3,)]


def test_bodies_that_do_not_fit_the_schema_are_errors(spark):
    bodies = {"fits": '{"k": 1}', "less": "{}", "more": '{"k": 2, "x": []}', "type": '{"k": "x"}', "list": "[1, 2]",
              "number": "7", "cut": '{"k": 1', "empty": "", "none": None, "null": " null "}
    frame_ = spark.createDataFrame([(n, 200, "OK", b) for n, b in bodies.items()], SCHEMA)
    found = json_bodies(frame_, schema="k bigint")
    assert {r.response_id: r.k for r in found.bodies.select("response_id", "json.k").collect()} \
        == {"fits": 1, "less": None, "more": 2, "null": None}
    assert reasons(found.errors) == {n: "bad json" for n in ("type", "list", "number", "cut", "empty", "none")}
