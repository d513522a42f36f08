"""Records out of response envelopes, and whole chains of pages.

Pages are rows with a JSON ``body``. A body that is not JSON raises: a response
that cannot be read is not a response without records.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from landfall.operators.joins import join_null_safe, splittable

_STRICT = {"mode": "FAILFAST"}


def read_bodies(spark: SparkSession, path: str, one_per_file: bool = False) -> DataFrame:
    """Landed responses as rows of ``body``: one per line, or one per file."""
    return spark.read.text(path, wholetext=one_per_file).withColumnRenamed("value", "body")


def nested_schema(leaves: Mapping[str, T.DataType]) -> T.StructType:
    """The smallest schema that reaches every ``{a.b: type}``."""
    below: dict[str, dict[str, T.DataType]] = {}
    fields: dict[str, T.DataType] = {}
    for path, leaf in leaves.items():
        head, _, rest = path.partition(".")
        if rest:
            below.setdefault(head, {})[rest] = leaf
        else:
            fields[head] = leaf
    fields.update({head: nested_schema(inner) for head, inner in below.items()})
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


def list_at(body: Column, selector: str, record: T.StructType | str) -> Column:
    """The array of records at a declared path; null where there is none."""
    record = T.StructType.fromDDL(record) if isinstance(record, str) else record
    schema = nested_schema({selector: T.ArrayType(record)})
    return _follow(F.from_json(body, schema, _STRICT), selector)


def scan_envelope(
    pages: DataFrame,
    selector: str,
    record: T.StructType | str,
    keep: Sequence[str] = (),
    body: str = "body",
) -> DataFrame:
    """One row per record of the declared list, with the page columns in ``keep``.

    The schema handed to the parser names only what is asked for, so the rest of
    each body is skipped, not built.
    """
    found = pages.select(*keep, F.explode(list_at(F.col(body), selector, record)).alias("_r"))
    return found.select(*keep, "_r.*")


def scan_envelope_auto(
    pages: DataFrame,
    keep: Sequence[str] = (),
    body: str = "body",
    endpoint: Sequence[str] = (),
    selector: str | None = None,
) -> DataFrame:
    """One ``record`` (VARIANT) per element of each envelope's list, and the
    ``list_key`` it stood under (null for a bare list).

    No key is declared, so it is found once for all pages of an endpoint (the columns
    ``endpoint``; without any, all pages are of one), however long its lists are on a page:
    the one list, at the top or one level below, that holds objects on any page; if none
    does, the one list that holds anything. Several are an error that names
    them, which ``selector`` settles. Pages without that list give no rows, and an
    envelope never lands itself.
    """
    kept = list(dict.fromkeys([*keep, *endpoint]))
    parsed = pages.select(*kept, F.parse_json(body).alias("_envelope"))
    lists = parsed.select(*kept, F.expr(_LISTS).alias("_lists"))
    if selector is not None:
        told = lists.withColumn("_path", F.lit(selector))
    else:
        found = lists.select(*endpoint, F.explode("_lists").alias("_l")).groupBy(*endpoint, "_l.key").agg(
            F.bool_or(F.expr("exists(_l.items, i -> schema_of_variant(i) LIKE 'OBJECT%')")).alias("_objects"),
            F.bool_or(F.expr("size(_l.items) > 0")).alias("_filled"))
        paths = found.groupBy(*endpoint).agg(
            F.array_sort(F.collect_set(F.when(F.col("_objects"), F.col("key")))).alias("_rich"),
            F.array_sort(F.collect_set(F.when(F.col("_filled"), F.col("key")))).alias("_any"))
        usable = F.when(F.size("_rich") > 0, F.col("_rich")).otherwise(F.col("_any"))
        complaint = F.concat(F.lit("records may be any of these lists: "), F.array_join(usable, ", "))
        path = F.when(F.size(usable) > 1, F.raise_error(complaint).cast("string")).otherwise(
            F.try_element_at(usable, F.lit(1)))
        paths = paths.select(*endpoint, path.alias("_path"), F.lit(1).alias("_one"))
        told = join_null_safe(lists.withColumn("_one", F.lit(1)), paths, [*endpoint, "_one"], "left")
    items = F.expr("get(filter(_lists, l -> l.key = _path), 0).items")
    return told.select(*keep, F.nullif(F.col("_path"), F.lit("")).alias("list_key"), F.explode(items).alias("record"))


# Every list of an envelope, bare, at the top or one level below, under its path.
_LISTS = """
    filter(
      concat(
        array(named_struct('key', '', 'items', try_cast(_envelope AS array<variant>))),
        flatten(transform(
          coalesce(map_entries(try_cast(_envelope AS map<string, variant>)), array()),
          e -> concat(
            array(named_struct('key', e.key, 'items', try_cast(e.value AS array<variant>))),
            transform(
              coalesce(map_entries(try_cast(e.value AS map<string, variant>)), array()),
              f -> named_struct('key', concat(e.key, '.', f.key), 'items', try_cast(f.value AS array<variant>))))))),
      l -> l.items IS NOT NULL)
"""


def records_as_columns(
    records: DataFrame, schema: T.StructType | str, record: str = "record"
) -> DataFrame:
    """VARIANT records as columns. A field the record lacks is null; a field typed
    ``variant`` stays open, for values whose keys or types vary."""
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    kept = [name for name in records.columns if name != record]
    typed = records.withColumn(record, F.col(record).cast(schema))
    return typed.select(*kept, f"{record}.*")


def _follow(value: Column, path: str) -> Column:
    for step in path.split("."):
        value = value.getField(step)
    return value


def chain_ends(
    pages: DataFrame,
    chain: Sequence[str],
    selector: str,
    total_path: str,
    page: str = "page",
    body: str = "body",
) -> DataFrame:
    """``last_page`` per chain: the first page that reaches its own declared page
    count, or the first empty page where no count is declared. Null when the
    landed pages never reach an end."""
    wanted = nested_schema(
        {selector: T.ArrayType(T.StringType()), total_path: T.IntegerType()}
    )
    envelope = F.col("_envelope")
    read = pages.select(
        *chain,
        F.col(page).alias("_page"),
        F.from_json(F.col(body), wanted, _STRICT).alias("_envelope"),
    ).select(
        *chain,
        "_page",
        F.coalesce(F.size(_follow(envelope, selector)), F.lit(0)).alias("_items"),
        _follow(envelope, total_path).alias("_total"),
    )
    at_end = F.when(F.col("_total").isNull(), F.col("_items") <= 0).otherwise(
        F.col("_page") >= F.col("_total")
    )
    return read.groupBy(*chain).agg(F.min(F.when(at_end, F.col("_page"))).alias("last_page"))


def up_to_end(
    pages: DataFrame, chain: Sequence[str], ends: DataFrame, page: str = "page"
) -> DataFrame:
    return join_null_safe(pages, splittable(ends, chain), chain, "left").filter(
        F.col("last_page").isNull() | (F.col(page) <= F.col("last_page"))
    )


def scan_pages_numbered(
    pages: DataFrame,
    chain: Sequence[str],
    selector: str,
    record: T.StructType | str,
    total_path: str = "_meta.pageCount",
    page: str = "page",
    body: str = "body",
) -> DataFrame:
    """Records of every page up to its chain's end; later pages are not read.

    The end is an aggregate per chain, joined back, so bodies never shuffle while
    that aggregate is small, and a chain of very many pages is split over tasks.
    """
    ends = chain_ends(pages, chain, selector, total_path, page, body)
    read = up_to_end(pages, chain, ends, page)
    return scan_envelope(read, selector, record, keep=[*chain, page], body=body)


def numbered_chain_gaps(
    pages: DataFrame, chain: Sequence[str], ends: DataFrame, page: str = "page", base: int = 1
) -> DataFrame:
    """Chains that were not read whole: pages missing before the end, or no end. The first
    page of a chain is number ``base``."""
    present = (
        up_to_end(pages, chain, ends, page)
        .groupBy(*chain, "last_page", page)
        .agg(F.lit(1).alias("_one"))
        .groupBy(*chain, "last_page")
        .agg(F.count("_one").alias("pages_read"))
    )
    return present.filter(
        F.col("last_page").isNull() | (F.col("pages_read") < F.col("last_page") - base + 1)
    )


def page_chain_gaps(pages: DataFrame, chain: Sequence[str] = ("resource",)) -> DataFrame:
    """What breaks a cursor chain. Pages are rows of the columns ``chain`` (what has tokens of
    its own: a resource, or a resource and a parent), ``cursor_in`` (null on the first
    page), ``next`` and ``items`` (their number).

    ``dangling_next``: a page with rows names a next page that never landed.
    ``past_end``: a landed page that no page before the end leads to. A next token
    on an empty page is not followed, so it is neither.
    """
    followed = pages.filter((F.col("items") > 0) & (F.coalesce("next", F.lit("")) != "")).select(
        *chain, F.col("next").alias("token")
    )
    landed = pages.filter(F.col("cursor_in").isNotNull()).select(
        *chain, F.col("cursor_in").alias("token")
    )
    key = [*chain, "token"]
    dangling = join_null_safe(followed.distinct(), landed, key, "left_anti")
    past = join_null_safe(landed.distinct(), followed, key, "left_anti")
    return dangling.withColumn("problem", F.lit("dangling_next")).unionByName(
        past.withColumn("problem", F.lit("past_end"))
    )


def chain_complete(resources: DataFrame, gaps: DataFrame, resource: str = "resource") -> DataFrame:
    """Per resource, whether its chain is whole: what licenses a soft delete."""
    broken = gaps.select(resource).distinct().withColumn("_broken", F.lit(True))
    return resources.select(resource).distinct().join(broken, resource, "left").select(
        resource, F.col("_broken").isNull().alias("complete")
    )
