"""Contract checks and suites."""

from datetime import datetime

from pyspark.sql import functions as F

from entry_queries.inputs import KEYS, TABLES, k_of, table
from entry_queries.registry import query
from landfall.contract import Contract
from landfall.operators import checks as C
from landfall.plans.suite import validate_suite

AS_OF = datetime(2024, 2, 2)

VERDICT = ("asset", "description", "success", "observed_value")

SHOP = Contract.from_dict({
    "name": "shop",
    "api": {"base_url": "https://shop.invalid", "auth": {"type": "bearer", "token_env": "SHOP"}},
    "resources": [
        {"name": "customer", "primary_key": "c_custkey", "soft_delete": "always"},
        {"name": "orders", "primary_key": "o_orderkey",
         "incremental": {"strategy": "search_window", "cursor_field": "o_orderdate"}},
        {"name": "lineitem", "primary_key": ["l_orderkey", "l_linenumber"],
         "incremental": {"strategy": "parent_watermark", "parent": "orders"}},
        {"name": "events", "primary_key": "event_id", "timestamp_columns": ["ts"]},
        {"name": "returns", "primary_key": "return_id"},
    ],
    "quality": {
        "required": ["orders"],
        "freshness": {"table": "events", "column": "ts", "hours": 48},
        "max_deleted_fraction": 0.05,
        "not_null": {"orders": ["o_orderdate"], "events": ["user_id", "high_k"],
                     "returns": ["reason"]},
        "references": [
            {"child": "orders.o_custkey", "parent": "customer.c_custkey"},
            {"child": "lineitem.l_orderkey", "parent": "orders.o_orderkey", "severity": "warn"},
            {"child": "returns.order_id", "parent": "orders.o_orderkey"},
        ],
    },
})


def shop_tables(spark, sf_dir):
    """The shop as it landed: pending orders are missing, some customers are
    flagged, ``high_k`` is often null, and returns never landed."""
    return {
        "customer": table(spark, sf_dir, "customer").withColumn(
            "_deleted", F.col("c_acctbal") < 0
        ),
        "orders": table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") != "P"),
        "lineitem": table(spark, sf_dir, "lineitem"),
        "events": table(spark, sf_dir, "events").withColumn(
            "high_k", F.when(k_of() >= 50, k_of())
        ),
    }


def verdicts(spark, tables, checks, checkpoint="raw_shop", as_of=AS_OF):
    return C.evaluate(spark, tables, checks, checkpoint, as_of).select(*VERDICT)


def verdict_sql(asset, description, count, test="= 0", source=""):
    """One verdict: ``count`` is a scalar expression over ``source``."""
    return (
        f"SELECT 'raw_shop.{asset}' AS asset, '{description}' AS description, "
        f"n {test} AS success, CAST(n AS VARCHAR) AS observed_value "
        f"FROM (SELECT {count} AS n {source})"
    )


def identity_sql(name, source=None):
    keys, source = KEYS[name], source or name
    listed = ", ".join(keys)
    unique = f"{name}.{listed} is unique" if len(keys) == 1 else f"{name} ({listed}) is unique"
    many = f"(SELECT 1 FROM {source} GROUP BY {listed} HAVING count(*) > 1)"
    parts = [
        verdict_sql(name, f"{name}.{key} is never null",
                    f"count(*) FILTER (WHERE {key} IS NULL)", source=f"FROM {source}")
        for key in keys
    ]
    parts.append(verdict_sql(name, unique, "count(*)", source=f"FROM {many}"))
    parts.append(verdict_sql(
        name, f"{name} has at least one row (an empty table means the fetch failed silently)",
        "count(*)", ">= 1", f"FROM {source}",
    ))
    return parts


def union(parts):
    return "\nUNION ALL\n".join(parts)


@query("check_not_null", "SELECT event_id, ts FROM events WHERE event_type = 'error'")
def check_not_null_query(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        "event_id", "ts", F.nullif(F.col("event_type"), F.lit("error")).alias("kind")
    )
    return C.null_rows(events, "kind").select("event_id", "ts")


@query("check_unique", """
SELECT l_orderkey, count(*) AS seen FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1
""")
def check_unique_query(spark, sf_dir):
    return C.duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey"])


@query("check_unique_composite", """
SELECT l_orderkey, l_linenumber, count(*) AS seen FROM lineitem
GROUP BY ALL HAVING count(*) > 1
""")
def check_unique_composite_query(spark, sf_dir):
    return C.duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("check_row_count", union(
    [
        verdict_sql(name, f"{name} has at least one row "
                    "(an empty table means the fetch failed silently)",
                    "count(*)", ">= 1", f"FROM {name}")
        for name in TABLES
    ]
    + [verdict_sql("refunds", "refunds has at least one row "
                   "(an empty table means the fetch failed silently)",
                   "count(*)", ">= 1", "FROM orders WHERE o_totalprice < 0")]
))
def check_row_count_query(spark, sf_dir):
    tables = {name: table(spark, sf_dir, name) for name in TABLES}
    tables["refunds"] = tables["orders"].filter(F.col("o_totalprice") < 0)
    return verdicts(spark, tables, [C.row_count(name) for name in tables])


@query("check_identity", union([part for name in TABLES for part in identity_sql(name)]))
def check_identity_query(spark, sf_dir):
    tables = {name: table(spark, sf_dir, name) for name in TABLES}
    checks = [check for name in TABLES for check in C.identity(name, KEYS[name])]
    return verdicts(spark, tables, checks)


ADVISORY = " (advisory: a quiet source looks the same as a stalled pipeline here)"


def fresh_sql(hours, severity):
    note = ADVISORY if severity == "warn" else ""
    return verdict_sql(
        "events", f"events.ts is within the last {hours}h{note}",
        f"CASE WHEN max(ts) < TIMESTAMP '2024-02-02' - INTERVAL {hours} HOUR THEN 1 ELSE 0 END",
        source="FROM events",
    )


@query("check_freshness", union([
    fresh_sql(24, "warn"), fresh_sql(720, "error"),
    verdict_sql("none", f"none.ts is within the last 1h{ADVISORY}", "0"),
]))
def check_freshness_query(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    tables = {"events": events, "none": events.filter(F.col("event_id") < 0)}
    return verdicts(spark, tables, [
        C.freshness("events", "ts", 24), C.freshness("events", "ts", 720, "error"),
        C.freshness("none", "ts", 1),
    ])


def deleted_sql(fraction, expression):
    return verdict_sql(
        "customer",
        f"at most {fraction:.0%} of customer is tombstoned "
        "(more than that means a partial fetch was soft-deleted)",
        f"CASE WHEN avg(CASE WHEN {expression} THEN 1.0 ELSE 0.0 END) > {fraction} "
        "THEN 1 ELSE 0 END",
        source="FROM customer",
    )


@query("check_deleted_fraction", union([
    deleted_sql(0.5, "c_acctbal < 0"), deleted_sql(0.05, "c_acctbal < 0")
]))
def check_deleted_fraction_query(spark, sf_dir):
    flagged = F.when(F.col("c_mktsegment") != "", F.col("c_acctbal") < 0)
    customers = table(spark, sf_dir, "customer").withColumn("_deleted", flagged)
    return verdicts(spark, {"customer": customers}, [
        C.deleted_fraction("customer", 0.5), C.deleted_fraction("customer", 0.05)
    ])


@query("check_orphans", """
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
ANTI JOIN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P') ON l_orderkey = o_orderkey
WHERE l_orderkey IS NOT NULL
""")
def check_orphans_query(spark, sf_dir):
    tables = shop_tables(spark, sf_dir)
    lines = tables["lineitem"].select("l_orderkey", "l_linenumber", "l_partkey")
    return C.orphan_rows(lines, "l_orderkey", tables["orders"], "o_orderkey")


@query("check_declared_not_null", union([
    verdict_sql("orders", "orders.o_orderdate is never null",
                "count(*) FILTER (WHERE o_orderdate IS NULL)", source="FROM orders"),
    verdict_sql("events", "events.high_k is never null",
                "count(*) FILTER (WHERE CAST(json_extract_string(props, ''$.k'') AS BIGINT) < 50)"
                .replace("''", "'"), source="FROM events"),
    verdict_sql("events", "events.user_id is never null",
                "count(*) FILTER (WHERE user_id IS NULL)", source="FROM events"),
]))
def check_declared_not_null_query(spark, sf_dir):
    tables = {**shop_tables(spark, sf_dir), "orders": table(spark, sf_dir, "orders")}
    declared = [("orders", "o_orderdate"), ("events", "high_k"), ("events", "user_id")]
    return verdicts(spark, tables, [C.not_null(*entry) for entry in declared])


LANDED_ORDERS = "(SELECT * FROM orders WHERE o_orderstatus <> 'P') AS landed"

SUITE_SQL = union([
    *identity_sql("customer"), deleted_sql(0.05, "c_acctbal < 0"),
    *identity_sql("orders", LANDED_ORDERS),
    verdict_sql("orders", "orders.o_orderdate is never null",
                "count(*) FILTER (WHERE o_orderdate IS NULL)", source="FROM orders"),
    verdict_sql("orders", "every orders.o_custkey resolves to a loaded customer", "count(*)",
                source="FROM orders WHERE o_orderstatus <> 'P' AND o_custkey NOT IN "
                       "(SELECT c_custkey FROM customer)"),
    *identity_sql("lineitem"),
    verdict_sql("lineitem", "every lineitem.l_orderkey resolves to a loaded orders "
                "(advisory: the source itself retains children whose parent is gone)",
                "count(*)", source="FROM lineitem WHERE l_orderkey NOT IN "
                "(SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')"),
    *identity_sql("events"),
    verdict_sql("events", "events.user_id is never null",
                "count(*) FILTER (WHERE user_id IS NULL)", source="FROM events"),
    verdict_sql("events", "events.high_k is never null",
                "count(*) FILTER (WHERE CAST(json_extract_string(props, '$.k') AS BIGINT) < 50)",
                source="FROM events"),
    fresh_sql(48, "warn"),
])


@query("validate_suite", SUITE_SQL)
def validate_suite_query(spark, sf_dir):
    results = validate_suite(spark, SHOP, shop_tables(spark, sf_dir), AS_OF)
    return results.select(*VERDICT)


@query("suite_verdict", f"""
SELECT 'raw_shop' AS checkpoint, count(*) FILTER (WHERE success) AS passed,
       count(*) AS total,
       count(*) FILTER (WHERE NOT success AND description NOT LIKE '%(advisory:%') AS errors,
       count(*) FILTER (WHERE NOT success AND description LIKE '%(advisory:%') AS warnings,
       count(*) FILTER (WHERE NOT success AND description NOT LIKE '%(advisory:%') > 0 AS failed
FROM ({SUITE_SQL})
""")
def suite_verdict_query(spark, sf_dir):
    return C.suite_verdict(validate_suite(spark, SHOP, shop_tables(spark, sf_dir), AS_OF))
