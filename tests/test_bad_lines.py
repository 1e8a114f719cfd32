import pytest
from pyspark.errors import PySparkException

from conftest import land, plan_of
from tickloom.operators.bad_lines import parse_lines, parse_responses
from tickloom.plans.methods import schema_of
from tickloom.plans.read import read_landing
from tickloom.sources import shared

DAILY = "TIME_SERIES_DAILY"
HEADER = "timestamp,open,high,low,close,volume"
GOOD = [f"2021-04-0{day},1,2,0.5,1.5,{day}" for day in range(1, 6)]
BODIES = {
    "good": "\n".join([HEADER, *GOOD]),
    "crlf": "\r\n".join([HEADER.replace("timestamp", "time"), *GOOD, ""]),
    "empty": "",
    "blank": " \n ",
    "header_only": HEADER + "\n",
    "note": '{"Note": "limit"}',
    "long_note": '{\n "Note": "limit"\n}',
    "short_row": "\n".join([HEADER, *GOOD, "2021-04-06,1,2,3"]),
    "bad_number": "\n".join([HEADER, *GOOD[:2], "2021-04-06,1,x,3,4,5", *GOOD[2:]]),
    "blank_line": "\n".join([HEADER, *GOOD[:2], "", " ", *GOOD[2:]]),
}
BARS = {"good": 5, "crlf": 5, "short_row": 5, "bad_number": 5, "blank_line": 5}
ERRORS = {"note": "no header", "long_note": "no header", "short_row": "missing close",
          "bad_number": "bad high"}
SCHEMA = "symbol string, response_id string, status int, reason string, body string"


def responses(spark, rows=None):
    rows = rows or [(name, 200, "OK", body) for name, body in BODIES.items()]
    return spark.createDataFrame([(r[0], *r) for r in rows], SCHEMA)


def counts(bars):
    return {r.symbol: r["count"] for r in bars.groupBy("symbol").count().collect()}


def found_errors(errors):
    rows = errors.collect()
    found = {r.response_id.rsplit("/", 1)[-1]: r.reason for r in rows}
    assert len(found) == len(rows)
    return found


def landed(spark, tmp_path):
    for name, body in BODIES.items():
        land(tmp_path, DAILY, {"symbol": name}, {name: body})
    return str(tmp_path)


def read(spark, tmp_path, form, policy="quarantine"):
    if form == "bodies":
        return parse_responses(responses(spark), DAILY, zone="UTC", keys=("symbol",), on_bad_line=policy)
    return read_landing(spark, landed(spark, tmp_path), DAILY, zone="UTC", on_bad_line=policy)


@pytest.mark.parametrize("form", ["bodies", "files"])
def test_quarantine(spark, tmp_path, form):
    found = read(spark, tmp_path, form)
    assert counts(found.bars) == BARS
    assert found_errors(found.errors) == ERRORS
    assert found.bars.columns == ["symbol", *schema_of(DAILY).names]


@pytest.mark.parametrize("form", ["bodies", "files"])
def test_void_response(spark, tmp_path, form):
    found = read(spark, tmp_path, form, "void_response")
    assert counts(found.bars) == {k: v for k, v in BARS.items() if k not in ERRORS}
    assert found_errors(found.errors) == ERRORS


@pytest.mark.parametrize("form", ["bodies", "files"])
def test_void_is_part_of_quarantine(spark, tmp_path, form):
    kept, voided = read(spark, tmp_path, form), read(spark, tmp_path, form, "void_response")
    assert voided.bars.exceptAll(kept.bars).count() == 0


@pytest.mark.parametrize("body", ["short_row", "bad_number", "note"])
def test_fail_stops(spark, tmp_path, body):
    with pytest.raises(PySparkException):
        parse_responses(responses(spark, [(body, 200, "OK", BODIES[body])]), DAILY, zone="UTC",
                        on_bad_line="fail").bars.count()
    land(tmp_path, DAILY, {"symbol": body}, {body: BODIES[body]})
    with pytest.raises((PySparkException, ValueError)):
        read_landing(spark, str(tmp_path), DAILY, zone="UTC", on_bad_line="fail").bars.count()


def test_fail_passes_good_responses(spark, tmp_path):
    land(tmp_path, DAILY, {"symbol": "A"}, {"a": BODIES["crlf"], "b": ""})
    assert read_landing(spark, str(tmp_path), DAILY, zone="UTC", on_bad_line="fail").bars.count() == 5
    assert parse_responses(responses(spark, [("a", 200, "OK", BODIES["good"]), ("b", 200, "OK", "")]),
                           DAILY, zone="UTC", on_bad_line="fail").bars.count() == 5


def test_refused_responses_are_errors(spark):
    rows = [("a", 200, "OK", BODIES["good"]), ("b", 422, "Unprocessable", BODIES["good"]),
            ("c", 500, "Server Error", None), ("d", None, "no response: timed out", None)]
    found = parse_responses(responses(spark, rows), DAILY, zone="UTC", keys=("symbol",))
    assert counts(found.bars) == {"a": 5}
    assert found_errors(found.errors) == {
        "b": "status 422 Unprocessable", "c": "status 500 Server Error", "d": "no response: timed out"}


def test_empty_results_are_typed(spark):
    found = parse_responses(responses(spark, [("a", 200, "OK", "")]), DAILY, zone="UTC")
    assert found.bars.collect() == []
    assert [(f.name, f.dataType) for f in found.bars.schema] \
        == [(f.name, f.dataType) for f in schema_of(DAILY)]


def test_a_later_header_line_in_a_body_is_bad(spark):
    body = "\n".join([HEADER, GOOD[0], HEADER])
    found = parse_responses(responses(spark, [("a", 200, "OK", body)]), DAILY, zone="UTC")
    assert found.bars.count() == 1
    assert [r.reason for r in found.errors.collect()] == ["bad timestamp"]


def test_unknown_policy(spark):
    with pytest.raises(ValueError):
        parse_responses(responses(spark), DAILY, zone="UTC", on_bad_line="ignore")


def test_unchecked_headers_need_one_pass(spark, tmp_path):
    root = landed(spark, tmp_path)
    bars = read_landing(spark, root, DAILY, zone="UTC", check_header=False).bars
    plan = plan_of(bars)
    assert "Exchange" not in plan and "Join" not in plan
    assert counts(bars) == BARS


def test_lines_are_not_shuffled_for_the_verdict(spark, tmp_path):
    plan = plan_of(read(spark, tmp_path, "files", "void_response").bars)
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_a_large_verdict_is_joined_by_shuffle(spark, tmp_path):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = read(spark, tmp_path, "files", "void_response")
        assert "hashpartitioning" in plan_of(found.bars)
        assert counts(found.bars) == {k: v for k, v in BARS.items() if k not in ERRORS}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_key_filters_prune_and_tokens_are_read_once(spark, tmp_path):
    bars = read_landing(spark, landed(spark, tmp_path), DAILY, zone="UTC", check_header=False).bars
    plan = plan_of(bars.filter("symbol = 'good' and high > 1"))
    assert "PartitionFilters: [isnotnull(symbol" in plan
    # The only filters on text are those of the line itself.
    assert plan.count("split(") == 1


def test_big_file_is_split_over_tasks(spark, tmp_path):
    lines = [HEADER] + [f"2021-04-01,{i},2,0.5,1.5,1" for i in range(20000)]
    land(tmp_path, DAILY, {"symbol": "HOT"}, {"hot": "\n".join(lines)})
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        found = read_landing(spark, str(tmp_path), DAILY, zone="UTC")
        assert found.bars.rdd.getNumPartitions() > 4
        assert found.bars.count() == 20000 and found.errors.count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


ODD_HEADERS = {
    "note_first": "\n".join(["note", HEADER, GOOD[0], HEADER, GOOD[1]]),
    "twice": "\n".join(["", HEADER, GOOD[0], HEADER, GOOD[1]]),
    "headers_only": "\n".join([HEADER, HEADER]),
}


@pytest.mark.parametrize("policy", ["quarantine", "void_response"])
def test_both_paths_read_the_same_bytes_alike(spark, tmp_path, policy):
    bodies = BODIES | ODD_HEADERS
    for name, body in bodies.items():
        land(tmp_path, DAILY, {"symbol": name}, {name: body})
    rows = [(name, 200, "OK", body) for name, body in bodies.items()]
    whole = parse_responses(responses(spark, rows), DAILY, zone="UTC", keys=("symbol",), on_bad_line=policy)
    lines = read_landing(spark, str(tmp_path), DAILY, zone="UTC", on_bad_line=policy)
    assert sorted(map(str, whole.bars.collect())) == sorted(map(str, lines.bars.collect()))
    # A response without header has one error row in either path; its lines have none.
    reasons = [sorted((r.symbol, r.reason) for r in found.errors.collect()) for found in (whole, lines)]
    assert reasons[0] == reasons[1]
    assert ("note_first", "no header") in reasons[0] and ("twice", "bad timestamp") in reasons[0]


LINES = "symbol string, response_id string, line string, position int"


def line_rows(bad_symbol):
    return [(s, i, line, n) for s in ("A", None) for i in ("1", None)
            for n, line in enumerate([HEADER, GOOD[0], "x" if (s, i) == bad_symbol else GOOD[1]])]


@pytest.mark.parametrize("bad", [("A", "1"), (None, "1"), ("A", None), (None, None)])
def test_verdicts_hold_for_one_response_only(spark, bad):
    found = parse_lines(spark.createDataFrame(line_rows(bad), LINES), DAILY, zone="UTC", keys=("symbol",),
                        on_bad_line="void_response", position="position")
    assert {r.symbol: r["count"] for r in found.bars.groupBy("symbol").count().collect()} == {
        s: 2 if s == bad[0] else 4 for s in ("A", None)}
    assert [(r.symbol, r.response_id, r.line) for r in found.errors.collect()] == [(*bad, "x")]


def test_written_tables_can_be_discarded(spark):
    found = parse_lines(spark.createDataFrame(line_rows(("A", "1")), LINES), DAILY, zone="UTC", keys=("symbol",),
                        on_bad_line="void_response")
    assert found.bars.count() == 6 and len(found.written) == 2
    found.discard()
    with pytest.raises(Exception, match="not exist|FileNotFound|No such"):
        found.bars.count()


@pytest.mark.parametrize("policy", ["quarantine", "void_response"])
def test_verdicts_of_many_lines_are_made_in_small_tasks(spark, monkeypatch, policy):
    """A task groups few lines however many there are, one long response among them; bars and errors are the same."""
    rows = [("A", f"r{i}", line) for i in range(60) for line in ("timestamp,open,high,low,close,volume", f"2021-01-0{1 + i % 9},1,1,1,1,{i}")]
    rows += [("A", "long", f"2021-02-01,1,1,1,1,{i}") for i in range(200)] + [("A", "r7", "2021-01-09,1,x,1,1,1"), (None, None, "note")]
    lines = spark.createDataFrame(rows, "symbol string, response_id string, line string")
    dealt = []
    monkeypatch.setattr(type(lines), "repartition", lambda self, n, *c, f=type(lines).repartition: dealt.append((n, c)) or f(self, n, *c))
    found = []
    for most in (1 << 20, 32):
        monkeypatch.setattr(shared, "TASK_ROWS", most)
        parsed = parse_lines(lines, "TIME_SERIES_DAILY", zone="UTC", keys=("symbol",), on_bad_line=policy)
        found.append([sorted(map(str, df.collect())) for df in (parsed.bars, parsed.errors)])
    assert found[0] == found[1] and len(found[0][0]) == (59 if policy == "void_response" else 60)
    assert dealt == [(11, ("symbol", "response_id", "line"))]
