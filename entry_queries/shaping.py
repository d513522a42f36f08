"""Record shaping."""

from pyspark.sql import functions as F

from entry_queries.inputs import k_of, table, wall_clock
from entry_queries.registry import query
from landfall.contract import Resource
from landfall.functions.html import strip_html
from landfall.functions.naming import snake_case_columns
from landfall.functions.text import truncate_observed
from landfall.functions.timestamps import parse_timestamp
from landfall.operators.shape import (
    add_tombstone_flag,
    cast_hinted,
    contain_open_map,
    exclude_fields,
    flatten_json,
    inject_parent,
    promote_fields,
    sample_landed,
    shape,
)

K_SQL = "CAST(json_extract_string(props, '$.k') AS BIGINT)"


@query("shape_exclude", """
SELECT event_id, event_type, CAST(NULL AS VARCHAR) AS k FROM events
""")
def shape_exclude_query(spark, sf_dir):
    kept = exclude_fields(table(spark, sf_dir, "events"), ("props", "value", "ts", "user_id"))
    return promote_fields(kept, {"props.k": "k"})


@query("shape_flatten_json", """
SELECT o_orderkey,
       CAST(to_json({'status': nullif(o_orderstatus, 'P'), 'priority': o_orderpriority})
            AS VARCHAR) AS stage,
       CAST(to_json([o_orderkey, o_custkey]) AS VARCHAR) AS ids,
       o_orderdate AS placed
FROM orders
""")
def shape_flatten_json_query(spark, sf_dir):
    records = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.struct(
            F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("status"),
            F.col("o_orderpriority").alias("priority"),
        ).alias("stage"),
        F.array("o_orderkey", "o_custkey").alias("ids"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("placed"),
    )
    rows = flatten_json(records, timestamp_columns=("placed",))
    return rows.withColumn("placed", wall_clock(F.col("placed")))


@query("shape_promote", """
SELECT event_id, props, json_extract_string(props, '$.k') AS k,
       event_type AS event_type, CAST(NULL AS VARCHAR) AS missing,
       user_id AS owner_id
FROM events
""")
def shape_promote_query(spark, sf_dir):
    records = table(spark, sf_dir, "events").select(
        "event_id", "props", F.lit("overwritten").alias("event_type"),
        F.struct(F.struct("user_id").alias("owner"), "event_type").alias("meta"),
    )
    return promote_fields(records, {
        "props.k": "k",
        "meta.event_type": "event_type",
        "props.nowhere.at_all": "missing",
        "meta.owner.user_id": "owner_id",
    }).drop("meta")


@query("shape_promote_ts", f"""
SELECT event_id,
       CASE event_type
         WHEN 'error' THEN date_trunc('second', ts)
         WHEN 'view' THEN CAST(NULL AS TIMESTAMP)
         WHEN 'click' THEN ts
         ELSE date_trunc('millisecond', ts) END AS opened_at,
       CAST({K_SQL} AS VARCHAR) AS k
FROM events
""")
def shape_promote_ts_query(spark, sf_dir):
    moment = F.col("ts").cast("timestamp")
    number = F.when(F.col("event_type") == "error", F.unix_seconds(moment)).when(
        ~F.col("event_type").isin("view", "click"), F.unix_millis(moment)
    )
    text = F.when(
        F.col("event_type") == "click", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    )
    # A JSON field that is a number in some records and text in others.
    opened = F.coalesce(
        number.cast("string"), F.concat(F.lit('"'), text, F.lit('"')), F.lit("null")
    )
    records = table(spark, sf_dir, "events").select(
        "event_id",
        F.concat(F.lit('{"opened":'), opened, F.lit(',"k":'), k_of().cast("string"), F.lit("}"))
        .alias("metrics"),
    )
    resource = Resource(
        "events", ("event_id",), hint_columns=("opened_at",),
        promote={"metrics.opened": "opened_at", "metrics.k": "k"},
    )
    return records.transform(shape(resource)).select(
        "event_id", wall_clock(F.col("opened_at")).alias("opened_at"), "k"
    )


@query("parse_timestamp", """
SELECT event_id, date_trunc('second', ts) AS from_seconds,
       date_trunc('millisecond', ts) AS from_millis, ts AS from_text,
       CAST(CAST(ts AS DATE) AS TIMESTAMP) AS from_day,
       CASE WHEN event_type <> 'view' THEN date_trunc('second', ts) END AS from_mixed,
       TIMESTAMP '1970-01-01' AS from_zero, event_type = 'error' AS from_flag
FROM events
""")
def parse_timestamp_query(spark, sf_dir):
    moment = F.col("ts").cast("timestamp")
    seconds, millis = F.unix_seconds(moment), F.unix_millis(moment)
    in_millis = F.col("event_type").isin("error", "click")
    raw = table(spark, sf_dir, "events").select(
        "event_id",
        seconds.alias("from_seconds"),
        millis.alias("from_millis"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'").alias("from_text"),
        F.date_format("ts", "yyyyMMdd").alias("from_day"),
        F.when(F.col("event_type") == "view", F.lit(None))
        .otherwise(F.when(in_millis, seconds * 1000).otherwise(seconds).cast("double"))
        .alias("from_mixed"),
        (F.col("user_id") * 0).alias("from_zero"),
        (F.col("event_type") == "error").alias("from_flag"),
    )
    parsed = {
        field.name: parse_timestamp(F.col(field.name), field.dataType)
        for field in raw.schema.fields if field.name != "event_id"
    }
    return raw.select(
        "event_id",
        *[
            (value if name == "from_flag" else wall_clock(value)).alias(name)
            for name, value in parsed.items()
        ],
    )


@query("cast_hinted", """
SELECT event_id, ts AS updated_at, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS seen_at,
       event_type = 'error' AS _deleted
FROM events
""")
def cast_hinted_query(spark, sf_dir):
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    rows = table(spark, sf_dir, "events").select(
        "event_id", text.alias("updated_at"), text.alias("seen_at"),
        F.when(F.col("event_type") == "error", F.lit("true")).otherwise(F.lit("false"))
        .alias("_deleted"),
    )
    resource = Resource(
        "events", ("event_id",), soft_delete="always",
        timestamp_columns=("updated_at", "seen_at"), hint_columns=("updated_at",),
    )
    cast = cast_hinted(rows, resource)
    return cast.withColumn("updated_at", wall_clock(F.col("updated_at")))


@query("keep_sentinel_epoch", f"""
SELECT event_id, date_trunc('second', ts) AS created,
       CASE WHEN {K_SQL} < 50 THEN 0 ELSE CAST(floor(epoch(ts)) AS BIGINT) END
         AS scheduled_start
FROM events
""")
def keep_sentinel_epoch_query(spark, sf_dir):
    seconds = F.unix_seconds(F.col("ts").cast("timestamp"))
    records = table(spark, sf_dir, "events").select(
        "event_id", seconds.alias("created"),
        F.when(k_of() < 50, F.lit(0).cast("bigint")).otherwise(seconds).alias("scheduled_start"),
    )
    resource = Resource(
        "events", ("event_id",), timestamp_columns=("created",), hint_columns=("created",)
    )
    return records.transform(shape(resource)).withColumn("created", wall_clock(F.col("created")))


@query("strip_html", r"""
WITH bare AS (
  SELECT page_id,
         regexp_replace(
           regexp_replace(
             regexp_replace(html, '<(script|style)[^>]*>.*?</(script|style)>', '', 'gs'),
             '<!--.*?-->', '', 'gs'),
           '<[^>]*>', '', 'gs') AS text
  FROM pages)
SELECT page_id,
       regexp_replace(replace(replace(replace(replace(replace(replace(replace(
         text, '&copy;', '©'), '&middot;', '·'), '&nbsp;', chr(160)), '&quot;', '"'),
         '&#x27;', chr(39)), '&lt;', '<'), '&gt;', '>'), '&amp;?', '&', 'g') AS text
FROM bare
""")
def strip_html_query(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", strip_html(F.col("html")).alias("text"))


@query("snake_case_columns", """
SELECT o_orderkey AS order_key, o_custkey AS cust_key, o_orderstatus AS http_status,
       o_totalprice AS total_price2_pay, o_orderdate AS _order_updated_at,
       o_orderpriority AS priority_label
FROM orders
""")
def snake_case_columns_query(spark, sf_dir):
    renamed = table(spark, sf_dir, "orders").toDF(
        "orderKey", "custKey", "HTTPStatus", "totalPrice2Pay", "_orderUpdatedAt", "priority label"
    )
    return snake_case_columns(renamed)


@query("contain_open_map", """
WITH n AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL)
SELECT user_id,
       '{' || string_agg('"' || event_type || '":' || n, ',' ORDER BY event_type) || '}'
         AS metrics,
       max(n) FILTER (WHERE event_type = 'click') AS clicked,
       max(n) FILTER (WHERE event_type = 'bounce') AS bounced
FROM n GROUP BY user_id
""")
def contain_open_map_query(spark, sf_dir):
    counts = table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(
        F.count(F.lit(1)).alias("n")
    )
    entries = F.array_sort(F.collect_list(F.struct("event_type", "n")))
    per_user = counts.groupBy("user_id").agg(F.map_from_entries(entries).alias("metrics"))
    return contain_open_map(per_user, "metrics", {"click": "clicked", "bounce": "bounced"})


@query("add_tombstone_flag", """
SELECT c_custkey, coalesce(CASE WHEN c_acctbal < 5000 THEN c_acctbal < 0 END, false) AS _deleted
FROM customer
""")
def add_tombstone_flag_query(spark, sf_dir):
    sent = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(F.col("c_acctbal") < 5000, F.col("c_acctbal") < 0).alias("_deleted"),
    )
    return add_tombstone_flag(sent)


@query("inject_parent", """
SELECT l_linenumber, l_partkey, l_suppkey, o_orderkey AS order_id,
       o_orderdate AS _order_changed_at
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
""")
def inject_parent_query(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.lit("theirs").alias("order_id")
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    met = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    stamped = inject_parent(
        met, F.col("o_orderkey"), F.col("o_orderdate"), "order_id", "_order_changed_at"
    )
    return stamped.drop("l_orderkey", "o_orderkey", "o_orderdate")


@query("shape_record", f"""
SELECT event_id, date_trunc('millisecond', ts) AS ts, user_id, event_type, props,
       CAST(to_json({{'type': event_type, 'user': user_id}}) AS VARCHAR) AS meta,
       {K_SQL} AS k, date_trunc('second', ts) AS seen_at,
       CAST(NULL AS VARCHAR) AS secret, false AS _deleted
FROM events
""")
def shape_record_query(spark, sf_dir):
    moment = F.col("ts").cast("timestamp")
    records = table(spark, sf_dir, "events").select(
        "event_id", F.unix_millis(moment).alias("ts"), "user_id", "event_type", "props",
        F.struct(F.col("event_type").alias("type"), F.col("user_id").alias("user")).alias("meta"),
        F.struct(F.unix_seconds(moment).alias("at")).alias("visit"),
        F.struct("value").alias("internal"),
    )
    resource = Resource(
        "events", ("event_id",), soft_delete="always",
        timestamp_columns=("ts",), hint_columns=("ts", "seen_at"),
        promote={"props.k": "k", "visit.at": "seen_at", "internal.value": "secret"},
        exclude_columns=("internal",),
    )
    rows = records.transform(shape(resource, types={"k": "bigint"})).drop("visit")
    return rows.withColumns({name: wall_clock(F.col(name)) for name in ("ts", "seen_at")})


@query("sample_landed", """
SELECT * FROM (SELECT 'orders' AS resource, o_orderkey AS id, o_orderpriority AS label
               FROM orders ORDER BY o_orderkey LIMIT 20)
UNION ALL
SELECT * FROM (SELECT 'part', p_partkey, p_name FROM part ORDER BY p_partkey LIMIT 20)
""")
def sample_landed_query(spark, sf_dir):
    def landed(name, key, label):
        rows = table(spark, sf_dir, name).select(
            F.lit(name).alias("resource"), F.col(key).alias("id"), F.col(label).alias("label")
        )
        return sample_landed(rows, ("id",), 20)

    return landed("orders", "o_orderkey", "o_orderpriority").unionByName(
        landed("part", "p_partkey", "p_name")
    )


@query("observed_truncate", """
SELECT doc_id, CASE WHEN length(text) > 500 THEN substring(text, 1, 499) || '…' ELSE text END
         AS observed_value
FROM documents
""")
def observed_truncate_query(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", truncate_observed(F.col("text")).alias("observed_value")
    )
