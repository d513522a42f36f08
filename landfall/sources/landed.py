"""From landed response pages to records, by what the contract says of its paging.

Pages are rows: ``resource``, ``parent`` (the parent a child endpoint was asked for, else
null), ``page`` (its number) or ``cursor_in`` (the token it was asked with, null on the first) and
the JSON ``body``. The contract names where records stand, how pages follow each other and which
fields were asked for; completeness is read off the same pages, never assumed.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from landfall.contract import Contract, ContractError, Resource
from landfall.sources.chains import chain_breaks
from landfall.sources.envelope import (
    numbered_chain_gaps, records_as_columns, scan_envelope_auto, up_to_end,
)

CHAIN = ("resource", "parent")
PAGES = "resource string, parent string, page bigint, cursor_in string, body string"

# The ways of paging a contract may name, and where their settings stand by default.
KINDS = ("cursor", "page_number", "single_page")
CURSOR_PATH = "meta.next_cursor"


@dataclass(frozen=True)
class Paging:
    """How the pages of one resource follow each other; no kind means that nobody knows."""

    kind: str | None
    selector: str | None
    cursor_path: str = CURSOR_PATH
    total_path: str | None = None
    base_page: int = 1


def paging_of(contract: Contract, resource: Resource) -> Paging:
    """The endpoint's own paginator, else the source's."""
    told = contract.pagination
    declared: Any = resource.endpoint.get("paginator") or told.get("kind")
    settings: Mapping[str, Any] = declared if isinstance(declared, Mapping) else {**told, "type": declared}
    kind = settings.get("type")
    if kind == "auto":
        kind = None
    if kind is not None and kind not in KINDS:
        raise ContractError(f"{contract.name}.{resource.name}: no way of paging is called {kind!r}")
    selector = resource.endpoint.get("data_selector") or told.get("data_selector")
    return Paging(kind, selector, settings.get("cursor_path") or CURSOR_PATH, settings.get("total_path"),
                  int(settings.get("base_page", 1)))


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """A folder of landed pages, one JSON object a line, through Spark's own reader."""
    return spark.read.schema(PAGES).json(path, mode="FAILFAST")


def _own(pages: DataFrame, resource: Resource) -> DataFrame:
    """The resource's pages, in the columns of this module whatever others they have."""
    fields = T.StructType.fromDDL(PAGES)
    present = [F.col(f.name).cast(f.dataType).alias(f.name) if f.name in pages.columns
               else F.lit(None).cast(f.dataType).alias(f.name) for f in fields]
    return pages.select(*present).filter(F.col("resource") == resource.name)


def _at(path: str | None, kind: str) -> Column:
    if path is None:
        return F.lit(None).cast(kind)
    return F.try_variant_get(F.col("_envelope"), f"$.{path}", kind)


def page_facts(pages: DataFrame, paging: Paging) -> DataFrame:
    """What each page says of its chain, bodies parsed once: ``items``, ``next`` and ``total``."""
    if paging.selector is None:
        raise ContractError("pages can be counted only where the contract says where their records stand")
    parsed = pages.select(*CHAIN, "page", "cursor_in", F.parse_json("body").alias("_envelope"))
    items = _at(paging.selector, "array<variant>") if paging.selector else F.col("_envelope").cast("array<variant>")
    return parsed.select(
        *CHAIN, "page", "cursor_in", F.coalesce(F.size(items), F.lit(0)).alias("items"),
        _at(paging.cursor_path, "string").alias("next"), _at(paging.total_path, "bigint").alias("total"))


def numbered_ends(facts: DataFrame) -> DataFrame:
    """The first page of each chain that reaches its own count, or is empty where none is told."""
    at_end = F.when(F.col("total").isNull(), F.col("items") <= 0).otherwise(F.col("page") >= F.col("total"))
    return facts.groupBy(*CHAIN).agg(F.min(F.when(at_end, F.col("page"))).alias("last_page"))


def records_from_pages(pages: DataFrame, contract: Contract, resource: Resource) -> DataFrame:
    """The resource's records as columns, up to each chain's end.

    The fields asked for by name are the columns, in that order, whether or not a record has
    them; without such a list they are what the records hold. A field that is a number, truth or text
    on every record has that type, the widest of those seen; all others stay open (VARIANT).
    """
    paging, own = paging_of(contract, resource), _own(pages, resource)
    if paging.kind == "page_number" and paging.selector is not None:
        own = up_to_end(own, CHAIN, numbered_ends(page_facts(own, paging)))
    records = scan_envelope_auto(own, endpoint=["resource"], selector=paging.selector).select("record")
    return records_as_columns(records, record_schema(records, resource.requested_fields))


def record_schema(records: DataFrame, wanted: tuple[str, ...] | None) -> T.StructType:
    """The least schema that holds every record: one merged text comes to the driver."""
    merged = records.agg(F.schema_of_variant_agg("record")).first()[0]
    found = _fields(merged)
    names = wanted if wanted is not None else tuple(found)
    return T.StructType([T.StructField(name, found.get(name, T.StringType())) for name in names])


def _fields(merged: str | None) -> dict[str, T.DataType]:
    if not merged or not merged.startswith("OBJECT<"):
        return {}
    # Outside of quoted names an object is what Spark's types call a struct.
    parts = re.split(r"(`(?:[^`]|``)*`)", merged)
    told = "".join(p if p.startswith("`") else p.replace("OBJECT<", "STRUCT<").replace("VOID", "STRING") for p in parts)
    out = {}
    for field in T.StructType.fromDDL(f"r {told}")["r"].dataType.fields:
        nested = isinstance(field.dataType, (T.StructType, T.ArrayType, T.VariantType))
        out[field.name] = T.VariantType() if nested else field.dataType
    return out


def chains_complete(pages: DataFrame, contract: Contract, resource: Resource) -> bool | None:
    """Whether every chain of the resource was read to its end; None where the paging can't tell.

    A resource without a page is not complete.
    """
    paging, own = paging_of(contract, resource), _own(pages, resource)
    if paging.kind is None or paging.selector is None and paging.kind != "single_page":
        return None
    if own.isEmpty():
        return False
    if paging.kind == "single_page":
        return True
    facts = page_facts(own, paging)
    if paging.kind == "page_number":
        return numbered_chain_gaps(own, CHAIN, numbered_ends(facts), base=paging.base_page).isEmpty()
    headless = facts.groupBy(*CHAIN).agg(F.bool_or(F.col("cursor_in").isNull()).alias("_first")).filter("not _first")
    return headless.isEmpty() and chain_breaks(facts, CHAIN).isEmpty()
