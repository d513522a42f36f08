"""Which checks a contract implies, what they find, and what the log keeps."""

import json
from copy import deepcopy
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from landfall.contract import Contract
from landfall.operators import checks as C
from landfall.operators.runlog import RESULT_COLUMNS
from landfall.plans.suite import (
    MissingTablesError,
    log_rows,
    plan_suite,
    run_suite,
    validate_suite,
)

NOW = datetime(2024, 5, 1)

DOCUMENT = {
    "name": "desk",
    "api": {"base_url": "https://desk.invalid", "auth": {"type": "bearer", "token_env": "T"}},
    "resources": [
        {"name": "accounts", "primary_key": "id", "soft_delete": "always"},
        {"name": "teams", "primary_key": "id", "soft_delete": "always"},
        {"name": "issues", "primary_key": "id"},
        {"name": "lines", "primary_key": ["issueId", "lineNo"]},
    ],
    "quality": {
        "required": ["issues"],
        "freshness": {"table": "issues", "column": "updated_at", "hours": 24},
        "not_null": {"issues": ["title"]},
        "references": [
            {"child": "issues.account_id", "parent": "accounts.id"},
            {"child": "lines.issue_id", "parent": "issues.id", "severity": "warn"},
        ],
    },
}
CONTRACT = Contract.from_dict(DOCUMENT)


def texts(plan, table=None):
    return [c.description for c in plan.checks if table in (None, c.table)]


def test_every_table_is_checked_on_its_key_without_being_asked():
    plan = plan_suite(CONTRACT)
    for table in ("accounts", "teams", "issues"):
        assert {f"{table}.id is never null", f"{table}.id is unique"} <= set(texts(plan, table))
    assert {c.table for c in plan.checks} == set(CONTRACT.resource_names)


def test_a_composite_key_is_unique_as_a_tuple_in_landed_spelling():
    found = texts(plan_suite(CONTRACT), "lines")
    assert "lines (issue_id, line_no) is unique" in found
    assert "lines.issue_id is never null" in found and "lines.line_no is never null" in found
    assert "lines.issue_id is unique" not in found


def test_only_tombstoned_tables_get_the_tombstone_check():
    plan = plan_suite(CONTRACT)
    with_check = {c.table for c in plan.checks if "is tombstoned" in c.description}
    assert with_check == {"accounts", "teams"}
    assert any("at most 50% of accounts is tombstoned" in text for text in texts(plan))


def test_freshness_is_advisory_unless_the_contract_says_otherwise():
    plan = plan_suite(CONTRACT)
    advisory = [c.description for c in plan.checks if c.severity == "warn"]
    assert len(advisory) == 2
    assert any(t.startswith("issues.updated_at is within the last 24h") for t in advisory)
    assert any("within the last 6h" in t for t in texts(plan_suite(CONTRACT, None, 6)))
    strict = deepcopy(DOCUMENT)
    strict["quality"]["freshness"]["severity"] = "error"
    (fresh,) = [c for c in plan_suite(Contract.from_dict(strict)).checks if c.kind == "freshness"]
    assert fresh.severity == "error" and "advisory" not in fresh.description


def test_the_plan_is_narrowed_to_what_landed():
    everything = plan_suite(CONTRACT)
    plan = plan_suite(CONTRACT, {"issues", "lines", "accounts"})
    assert plan.skipped == ("teams",)
    assert texts(plan, "issues") == texts(everything, "issues")
    assert not any("loaded accounts" in t for t in texts(plan_suite(CONTRACT, {"issues"})))
    with pytest.raises(MissingTablesError, match="issues"):
        plan_suite(CONTRACT, {"accounts"})


def test_a_bare_contract_gets_identity_checks_and_nothing_else():
    bare = Contract.from_dict({**DOCUMENT, "resources": [{"name": "t", "primary_key": "id"}],
                               "quality": {}})
    plan = plan_suite(bare)
    assert [c.kind for c in plan.checks] == ["not_null", "unique", "row_count"]
    assert plan_suite(bare, set()).checks == ()


@pytest.fixture(scope="module")
def tables(spark):
    return {
        "accounts": spark.createDataFrame(
            [(1, False), (2, True), (3, True), (4, None)], "id int, _deleted boolean"),
        "issues": spark.createDataFrame(
            [(1, 1, "a", NOW - timedelta(hours=30)), (2, 9, None, None), (2, 9, "b", None),
             (None, None, "c", None), (None, 2, "d", None)],
            "id int, account_id int, title string, updated_at timestamp"),
        "lines": spark.createDataFrame(
            [(1, 1), (1, 2), (7, 1)], "issue_id int, line_no int"),
    }


def found(results):
    return {r.description: (r.success, r.observed_value) for r in results.collect()}


def test_verdicts_and_what_they_observed(spark, tables):
    rows = found(validate_suite(spark, CONTRACT, tables, NOW))
    assert rows["issues.id is never null"] == (False, "2")
    assert rows["issues.id is unique"] == (False, "2")
    assert rows["issues.title is never null"] == (False, "1")
    assert rows["every issues.account_id resolves to a loaded accounts"] == (False, "2")
    assert rows["lines (issue_id, line_no) is unique"] == (True, "0")
    fresh = next(v for k, v in rows.items() if "within the last 24h" in k)
    orphan = next(v for k, v in rows.items() if "lines.issue_id resolves" in k)
    deleted = next(v for k, v in rows.items() if "tombstoned" in k)
    assert (fresh, orphan, deleted) == ((False, "1"), (False, "1"), (True, "0"))
    count = next(v for k, v in rows.items() if k.startswith("issues has at least"))
    assert count == (True, "5")


def test_thresholds_are_strict(spark):
    half = spark.createDataFrame([(True,), (False,)], "_deleted boolean")
    on_time = spark.createDataFrame([(NOW - timedelta(hours=24),)], "at timestamp")
    checks = [C.deleted_fraction("half", 0.5), C.deleted_fraction("half", 0.49),
              C.freshness("on_time", "at", 24), C.freshness("on_time", "at", 23)]
    rows = C.evaluate(spark, {"half": half, "on_time": on_time}, checks, "raw_x", NOW).collect()
    assert sorted(r.success for r in rows) == [False, False, True, True]


def test_an_empty_table_fails_only_its_row_count(spark):
    empty = spark.createDataFrame([], "id int, at timestamp, _deleted boolean")
    checks = [*C.identity("t", ("id",)), C.freshness("t", "at", 1), C.deleted_fraction("t", 0.5)]
    rows = C.evaluate(spark, {"t": empty}, checks, "raw_x", NOW).collect()
    assert [r.expectation for r in rows if not r.success] == [C.ROW_COUNT]


def test_a_check_that_cannot_be_planned_fails_with_its_error(spark, tables):
    checks = [*C.identity("lines", ("issue_id", "line_no")), C.not_null("lines", "gone"),
              C.orphans("lines", "gone", "issues", "id"), C.unique("lines", ("gone",))]
    rows = C.evaluate(spark, tables, checks, "raw_desk", NOW).collect()
    assert len(rows) == len(checks)
    broken = [r for r in rows if "gone" in r.description]
    assert [r.success for r in broken] == [False] * 3
    assert all("gone" in r.observed_value and "gone" in json.loads(r.details)["exception"]
               for r in broken)
    assert all(r.success for r in rows if r not in broken)


def test_a_check_that_raises_on_its_data_hides_no_other(spark, tables):
    boom = F.when(F.col("id") == 2, F.raise_error(F.lit("boom " * 200))).otherwise(F.lit("x"))
    broken = {**tables, "issues": tables["issues"].withColumn("title", boom.cast("string"))}
    results, verdict = run_suite(spark, CONTRACT, broken, NOW)
    rows = found(results)
    success, observed = rows["issues.title is never null"]
    assert not success and "boom" in observed and len(observed) == 500
    assert rows["issues.id is unique"] == (False, "2")
    assert verdict.total == len(plan_suite(CONTRACT, tables).checks)


def test_only_errors_fail_the_suite(spark, tables, tmp_path):
    folder = str(tmp_path / "log")
    results, verdict = run_suite(spark, CONTRACT, tables, NOW, folder, {"dag_id": "d"})
    assert (verdict.failed, verdict.errors, verdict.warnings) == (True, 4, 2)
    assert verdict.passed + 6 == verdict.total
    log = spark.read.parquet(folder)
    assert set(RESULT_COLUMNS) < set(log.columns)
    assert log.select("dag_id", "validated_at").distinct().collect() == [("d", NOW)]
    assert log.count() == results.count() == verdict.total
    fine = results.filter("success OR severity = 'warn'")
    assert C.suite_verdict(fine).first().failed is False


def test_log_rows_have_the_fixed_order(spark, tables):
    rows = log_rows(validate_suite(spark, CONTRACT, tables, NOW), NOW)
    assert rows.columns == ["validated_at", *RESULT_COLUMNS]


def test_a_log_that_cannot_be_written_does_not_hide_the_verdict(spark, tables, capsys):
    _, verdict = run_suite(spark, CONTRACT, tables, NOW, "nosuchscheme://x/log")
    assert verdict.failed and "could not be logged" in capsys.readouterr().out


def test_orphans_exclude_nulls_and_duplicates_include_them(spark):
    child = spark.createDataFrame([(1,), (None,), (None,), (5,), (5,)], "fk int")
    parent = spark.createDataFrame([(1,), (1,), (None,)], "id int")
    assert [r.fk for r in C.orphan_rows(child, "fk", parent, "id").collect()] == [5, 5]
    assert [tuple(r) for r in C.orphan_keys(child, "fk", parent, "id").collect()] == [(5, 2)]
    doubled = {tuple(r) for r in C.duplicate_keys(child, ["fk"]).collect()}
    assert doubled == {(None, 2), (5, 2)}
    assert C.null_rows(child, "fk").count() == 2
