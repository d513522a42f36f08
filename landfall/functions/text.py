"""Text helpers of the logs and request counts."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The longest observed text a log keeps, and how a cut is marked.
OBSERVED_LIMIT = 500
CUT_MARK = "…"


def truncate_observed(value: Column, limit: int = OBSERVED_LIMIT) -> Column:
    return F.when(
        F.length(value) > limit,
        F.concat(F.substring(value, 1, limit - 1), F.lit(CUT_MARK)),
    ).otherwise(value)


def url_path(url: Column) -> Column:
    """The path of a URL: no scheme, host, query or fragment, and no ``;`` suffix
    on its last step."""
    whole = F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)", 1)
    return F.regexp_replace(whole, r";[^/]*$", "")
