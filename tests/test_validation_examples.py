"""Validation rules (V2-V8): one table of cases per rule, over records built from the declared
schemas."""

import json

import pytest
from pyspark.sql.types import StringType

from clickforge.operators import quarantine as Q
from clickforge.operators import validate as V
from clickforge.schemas import RAW_SCHEMAS
from clickforge.sources import raw as R

# What a field needs to pass; any other string field holds its own name, any number 7.
PASSING = {"page_type": "cart", "device_type": "tablet", "element_type": "menu", "category": "toys",
           "action": "remove", "timestamp": "2031-07-09T23:59:58-03:30", "price": 7.5}


def record(event_type, drop=(), **changes):
    out = {f.name: PASSING.get(f.name, f.name if isinstance(f.dataType, StringType) else 7)
           for f in RAW_SCHEMAS[event_type].fields}
    out.update(changes)
    return {k: v for k, v in out.items() if k not in drop}


def checked(spark, files, profile="ingest", split=3):
    """Annotated lines and parsed lines of ``{file type: [record or text]}``, ``split`` lines a
    split."""
    rows = [(f"raw/{t}.jsonl", 50, i // split * split, i, r if isinstance(r, str) else json.dumps(r))
            for t, recs in files.items() for i, r in enumerate(recs)]
    records = R.lines_to_records(spark.createDataFrame(
        rows, "file_path string, file_size long, block_start long, line_id long, line string"))
    return V.annotate(records, profile), records


def reasons(spark, event_type, records, profile="ingest"):
    """The reasons of each record, in order of the checks."""
    ann, parsed = checked(spark, {event_type: records}, profile)
    out = [[] for _ in records]
    for r in sorted(Q.ordered_errors(ann, parsed).collect(), key=lambda r: (r.record_index, r.pos)):
        out[r.record_index].append(r.reason)
    return out


@pytest.mark.parametrize("profile", ["ingest", "contract"])
@pytest.mark.parametrize("event_type", sorted(RAW_SCHEMAS))
def test_a_record_that_fits_has_no_error(spark, event_type, profile):
    assert reasons(spark, event_type, [record(event_type)], profile) == [[]]


def test_required_fields_come_first_and_alone(spark):
    got = reasons(spark, "search", [
        record("search", drop=["query"]), record("search", query=None),
        record("search", drop=["user_id"], session_id=None),
        record("search", drop=["query"], results_count="many", timestamp=1), []])
    missing, null = "Campo obligatorio faltante: '{}'", "Campo obligatorio es null: '{}'"
    assert got[:4] == [[missing.format("query")], [null.format("query")],
                       [missing.format("user_id"), null.format("session_id")],
                       [missing.format("query")]]
    assert len(got[4]) == 5  # a list is a record without any field


def test_types(spark):
    got = reasons(spark, "click", [
        record("click", x_position="7"), record("click", x_position=True, y_position=7.25),
        record("click", page_url=7), record("click", element_id=["a"]), record("click", page_url={}),
        record("click", y_position=10 ** 25)])
    wrong = "'{}' debe ser {}, recibido {}".format
    assert got == [[wrong("x_position", "int o float", "str")], [], [wrong("page_url", "str", "int")],
                   [wrong("element_id", "str", "list")], [wrong("page_url", "str", "dict")],
                   [f"'y_position' fuera de rango [0, 4320]: {10 ** 25}"]]


def test_contract_wants_integers(spark):
    got = reasons(spark, "click", [record("click", x_position=7.5), record("click", x_position=True),
                                   record("click", x_position=10 ** 19)], "contract")
    assert got[0] == ["'x_position' debe ser int, recibido float"]
    assert got[1] == ["'x_position' debe ser int, recibido bool"]
    assert got[2] == [f"'x_position' fuera de rango [0, 3840]: {10 ** 19}"]


def test_enums_are_case_sensitive_and_checked_after_a_type_error(spark):
    got = reasons(spark, "cart_event", [record("cart_event", action="Add"), record("cart_event", action=3)])
    assert got == [["'action' valor invalido: 'Add'"],
                   ["'action' debe ser str, recibido int", "'action' valor invalido: '3'"]]


def test_ranges_include_their_ends(spark):
    ends = [record("product_view", time_on_page_seconds=n) for n in (0, 1, 7200, 7201)]
    prices = [record("product_view", price=p) for p in (0.0, 0.01, 1_000_000, 1_000_000.5)]
    got = reasons(spark, "product_view", ends + prices + [json.dumps(record("product_view")).replace("7.5", "1E400")])
    out = "'{}' fuera de rango [{}, {}]: {}".format
    assert got == [[out("time_on_page_seconds", 1, 7200, 0)], [], [], [out("time_on_page_seconds", 1, 7200, 7201)],
                   [out("price", 0.01, 1000000, "0.0")], [], [], [out("price", 0.01, 1000000, "1000000.5")],
                   [out("price", 0.01, 1000000, "inf")]]


def test_timestamps(spark):
    good = ["2031-07-09T00:00:00Z", "2031-02-31T25:61:61+00:00", "2031-07-09T00:00:00.000001-11:00"]
    bad = ["2031-07-09", "2031-07-09 00:00:00Z", "2031-07-09T00:00:00", "2031-07-09T00:00:00+0000"]
    got = reasons(spark, "search", [record("search", timestamp=t) for t in good + bad + [7]])
    assert got[:3] == [[], [], []]
    assert got[3:7] == [[f"timestamp no tiene formato ISO8601: '{t}'"] for t in bad]
    assert got[7] == ["'timestamp' debe ser str, recibido int", "timestamp debe ser string, recibido int"]


def test_unknown_type_is_the_only_error(spark):
    assert reasons(spark, "login", [{"user_id": None}]) == [["Tipo de evento desconocido: 'login'"]]


def test_counts_and_positions_over_splits(spark):
    two = record("page_view", page_type="x", time_on_page_seconds=0)
    ann, parsed = checked(spark, {"page_view": [record("page_view"), "", "{", two, record("page_view"), " ", two, "7"]})
    s = V.validation_summary(ann).first()
    assert (s.records, s.valid_count, s.invalid_count, s.invalid_records, s.skipped_lines) == (5, 2, 12, 3, 1)
    errors = V.validation_errors(ann, parsed).collect()
    assert sorted({(e.record_index, e.user_id) for e in errors}) == [(1, "user_id"), (3, "user_id"), (4, "unknown")]
    assert sorted(tuple(r) for r in V.validation_errors(ann).collect()) == sorted(map(tuple, errors))
    assert sorted(r.line_id for r in V.valid_events(ann).collect()) == [0, 4]
