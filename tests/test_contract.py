"""Every malformed contract is refused, before any data moves."""

from copy import deepcopy
from datetime import datetime, timedelta

import pytest

from landfall.contract import Contract, ContractError, run_window
from landfall.operators.tombstone import soft_delete_eligible

MINIMAL = {
    "name": "shop",
    "api": {"base_url": "https://shop.invalid", "auth": {"type": "bearer", "token_env": "T"}},
    "resources": [{"name": "orders", "primary_key": "id"}],
}


def changed(path, value):
    document = deepcopy(MINIMAL)
    *steps, last = path
    at = document
    for step in steps:
        at = at[step]
    if value is None:
        del at[last]
    else:
        at[last] = value
    return document


def with_quality(**quality):
    document = deepcopy(MINIMAL)
    document["resources"].append({"name": "lines", "primary_key": ["order_id", "no"]})
    document["quality"] = quality
    return document


def test_a_minimal_contract_gets_its_defaults():
    contract = Contract.from_dict(MINIMAL)
    (orders,) = contract.resources
    assert contract.dataset == "raw_shop"
    assert (orders.primary_key, orders.strategy, orders.write_disposition) == (
        ("id",), "full_refresh", "merge")
    assert (orders.soft_delete, orders.family, orders.route) == (None, "orders", "/orders")
    assert contract.quality.max_deleted_fraction == 0.5


@pytest.mark.parametrize("document", [
    "not a mapping",
    changed(["resource"], []),
    changed(["name"], None),
    changed(["api"], None),
    changed(["api", "base_url"], None),
    changed(["api", "auth"], {"type": "bearer"}),
    changed(["resources"], []),
    changed(["resources"], {"orders": 1}),
    changed(["resources"], ["orders"]),
    changed(["resources", 0, "timestamp_column"], ["at"]),
    changed(["resources", 0, "primary_key"], None),
    changed(["resources", 0, "soft_delete"], True),
    changed(["resources", 0, "soft_delete"], "sometimes"),
    changed(["resources", 0, "write_disposition"], "upsert"),
    changed(["resources", 0, "incremental"], {"strategy": "guess"}),
    changed(["resources"], [MINIMAL["resources"][0]] * 2),
    changed(["resources", 0, "incremental"], {"parent": "nobody"}),
    changed(["resources", 0, "incremental"], {"parent": "orders"}),
    changed(["resources"], [
        {"name": "a", "primary_key": "id", "incremental": {"parent": "b"}},
        {"name": "b", "primary_key": "id", "incremental": {"parent": "a"}}]),
    changed(["resources", 0], {"name": "orders", "primary_key": "id", "soft_delete": "always",
                               "incremental": {"strategy": "search_window", "cursor_field": "at"}}),
    changed(["resources", 0, "incremental"], {"cursor_missing": "guess"}),
    changed(["resources", 0, "incremental"], {"initial_value": "soon"}),
    changed(["resources", 0, "incremental"], {"window_months": 6}),
    with_quality(fresh={}),
    with_quality(freshness={"table": "orders"}),
    with_quality(references=[{"child": "lines.order_id", "parent": "order.id"}]),
    with_quality(references=[{"child": "lines", "parent": "orders.id"}]),
    with_quality(references=[{"child": "lines.order_id"}]),
])
def test_a_malformed_contract_is_refused(document):
    with pytest.raises(ContractError):
        Contract.from_dict(document)


def test_all_problems_are_told_at_once():
    document = changed(["resources", 0, "soft_delete"], "sometimes")
    document["extra"] = 1
    del document["api"]["base_url"]
    with pytest.raises(ContractError) as caught:
        Contract.from_dict(document)
    assert all(part in str(caught.value) for part in ("soft_delete", "'extra'", "base_url"))


def test_hints_default_to_the_timestamps_and_may_be_narrowed():
    def hints(**entry):
        return Contract.from_dict(changed(["resources"], [
            {"name": "o", "primary_key": "id", "timestamp_columns": ["a", "b"], **entry}
        ])).resources[0].hint_columns

    assert hints() == ("a", "b")
    assert hints(hint_columns=["a"]) == ("a",)
    assert hints(hint_columns=[]) == ()


def test_requested_fields_come_from_the_endpoint():
    def fields(params):
        return Contract.from_dict(changed(["resources", 0, "endpoint"], {"params": params})
                                  ).resources[0].requested_fields

    assert fields({"fields": "id,name, at"}) == ("id", "name", "at")
    assert fields({"include": ["id", "at"]}) == ("id", "at")
    assert fields({}) is None


def test_the_endpoint_may_stand_under_the_strategy():
    entry = {"strategy": "search_window", "cursor_field": "at",
             "endpoint": {"path": "/o", "family": "all"}}
    orders = Contract.from_dict(changed(["resources", 0, "incremental"], entry)).resources[0]
    assert (orders.route, orders.family, orders.cursor_field) == ("/o", "all", "at")


def test_resources_are_selected_by_name():
    contract = Contract.from_dict(with_quality())
    assert [r.name for r in contract.select("all")] == ["orders", "lines"]
    assert [r.name for r in contract.select(" lines ,")] == ["lines"]
    with pytest.raises(ContractError, match="nope.*orders, lines"):
        contract.select("orders,nope")


NOW = datetime(2024, 5, 1, 12)


def test_window_rules():
    assert run_window(NOW).mode == "incremental"
    window = run_window(NOW, start=datetime(2024, 1, 1))
    assert (window.mode, window.end, window.end_is_current) == ("window", NOW, True)
    assert not run_window(NOW, start=datetime(2024, 1, 1), end=NOW - timedelta(hours=2)
                          ).end_is_current
    for wrong in ({"mode": "window"}, {"mode": "incremental", "start": NOW},
                  {"end": NOW}, {"mode": "all"}, {"start": NOW, "end": NOW}):
        with pytest.raises(ContractError):
            run_window(NOW, **wrong)


def eligible(window, requested=True, complete=None):
    document = changed(["resources"], [
        {"name": "small", "primary_key": "id", "soft_delete": "always"},
        {"name": "history", "primary_key": "id", "soft_delete": "full_history"},
        {"name": "searched", "primary_key": "id", "soft_delete": "full_history",
         "incremental": {"strategy": "search_window", "cursor_field": "at"}},
        {"name": "kept", "primary_key": "id"},
    ])
    document["orchestration"] = {"backfill_start": "2020-01-01"}
    contract = Contract.from_dict(document)
    return soft_delete_eligible(contract, contract.resources, window, requested, complete)


def test_only_runs_that_saw_everything_may_tombstone_history():
    whole = run_window(NOW, start=datetime(2019, 1, 1))
    seen = dict.fromkeys(("small", "history", "searched"), True)
    assert eligible(whole, complete=seen).eligible == ("small", "history")
    assert eligible(whole).eligible == () and "nothing says" in eligible(whole).skipped["small"]
    assert "search_window" in eligible(whole).skipped["searched"]
    for partial in (run_window(NOW), run_window(NOW, start=datetime(2021, 1, 1)),
                    run_window(NOW, start=datetime(2019, 1, 1), end=datetime(2024, 1, 1))):
        assert eligible(partial, complete=seen).eligible == ("small",)
    assert eligible(whole, requested=False).eligible == ()


def test_a_table_whose_page_chain_has_gaps_is_not_tombstoned():
    plan = eligible(run_window(NOW), complete={"small": False})
    assert plan.eligible == () and "gaps" in plan.skipped["small"]
