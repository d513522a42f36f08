"""Requests by the budget they spend."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from landfall.contract import Contract
from landfall.functions.text import url_path

# Fixed value: the family of a request no declared route explains.
UNMATCHED = "unmatched"


def routes_of(contract: Contract) -> dict[str, str]:
    """The family of each route; of resources that share one the first declared says."""
    routes: dict[str, str] = {}
    for resource in contract.resources:
        routes.setdefault(resource.route, resource.family)
    return routes


def request_family(url: Column, routes: Mapping[str, str]) -> Column:
    """The family of the longest declared route the URL's path contains, of equally long ones
    the first declared.

    Routes are contract metadata, so longest-first is an expression: no join, no
    grouping, one pass inside the scan's own stage.
    """
    path = url_path(url)
    longest_last = sorted((route for route in reversed(list(routes)) if route), key=len)
    return reduce(
        lambda shorter, route: F.when(
            F.contains(path, F.lit(route)), F.lit(routes[route])
        ).otherwise(shorter),
        longest_last,
        F.lit(UNMATCHED),
    )


def requests_by_family(requests: DataFrame, url: str, routes: Mapping[str, str]) -> DataFrame:
    family = request_family(F.col(url), routes).alias("family")
    return requests.groupBy(family).agg(F.count(F.lit(1)).alias("requests"))
