"""The source contract: one mapping per source, read and judged before any data moves.

A contract names a source's tables, their keys, which fields are timestamps,
which nested values become columns, how each table is fetched incrementally and
what "arrived correctly" means. Each block is described once, as data: its settings,
how each is read, which are needed and what holds in their absence. One reader
walks all blocks and gathers every problem, so an author sees them together.

Everything here is driver-side metadata. No DataFrame is touched.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from datetime import datetime, timedelta
from typing import Any, NamedTuple

# The contract's vocabulary.
STRATEGIES = ("full_refresh", "parent_fanout", "parent_watermark", "search_window")
SOFT_DELETE_MODES = ("always", "full_history")
WRITE_DISPOSITIONS = ("merge", "replace", "append")
CURSOR_MISSING = ("include", "exclude", "raise")

# The strategies a run's start/end window bounds. Only a collection that is read
# whole can be said to have been seen whole.
WINDOWED_STRATEGIES = ("full_refresh",)

DEFAULT_MAX_DELETED_FRACTION = 0.5
DEFAULT_FRESHNESS_HOURS = 24
CURRENT_WITHIN = timedelta(hours=1)


class ContractError(ValueError):
    """A contract that cannot be trusted to describe a source."""


# ── how single values are read ───────────────────────────────────────────────
# A reader returns the value to keep, or raises ValueError saying what would do.


def _text(value: Any) -> str:
    if not isinstance(value, str):
        raise ValueError("text")
    return value


def _names(value: Any) -> tuple[str, ...]:
    listed = (value,) if isinstance(value, str) else value
    if not isinstance(listed, (list, tuple)) or not all(isinstance(name, str) for name in listed):
        raise ValueError("a name or a list of names")
    return tuple(listed)


def _table(value: Any) -> dict[str, Any]:
    if not isinstance(value, Mapping):
        raise ValueError("a mapping")
    return dict(value)


def _name_lists(value: Any) -> dict[str, tuple[str, ...]]:
    return {key: _names(names) for key, names in _table(value).items()}


def _list(value: Any) -> list[Any]:
    if not isinstance(value, (list, tuple)):
        raise ValueError("a list")
    return list(value)


def _number(kind: type) -> Callable[[Any], Any]:
    def read(value: Any) -> Any:
        if isinstance(value, bool):
            raise ValueError("a number")
        try:
            return kind(value)
        except TypeError as wrong:
            raise ValueError("a number") from wrong

    return read


def _moment(value: Any) -> datetime:
    return value if isinstance(value, datetime) else datetime.fromisoformat(_text(value))


def _choice(*words: str, off: bool = False) -> Callable[[Any], str | None]:
    """One of some words; ``off`` also lets the setting be switched off by false."""

    def read(value: Any) -> str | None:
        if off and value is False:
            return None
        if value not in words or isinstance(value, bool):
            raise ValueError(" or ".join(words))
        return value

    return read


def _severity(value: Any) -> str:
    return "warn" if value == "warn" else "error"


def _column(value: Any) -> tuple[str, str]:
    table, _, column = str(value).partition(".")
    if not table or not column:
        raise ValueError("table.column")
    return table, column


# ── what each block may say ──────────────────────────────────────────────────


class Setting(NamedTuple):
    read: Callable[[Any], Any]
    needed: bool = False
    default: Any = None


Block = Mapping[str, Setting]

AUTH: Block = {"type": Setting(_text, True), "token_env": Setting(_text, True)}
API: Block = {"base_url": Setting(_text, True), "auth": Setting(_table, True)}
INCREMENTAL: Block = {
    "strategy": Setting(_choice(*STRATEGIES), default="full_refresh"),
    "parent": Setting(_text),
    "cursor_field": Setting(_text),
    "lookback_seconds": Setting(_number(int), default=0),
    "cursor_missing": Setting(_choice(*CURSOR_MISSING)),
    "initial_value": Setting(_moment),
    "window_field": Setting(_text),
    "window_months": Setting(_number(int)),
    "endpoint": Setting(_table, default={}),
}
RESOURCE: Block = {
    "name": Setting(_text, True),
    "primary_key": Setting(_names, True),
    "write_disposition": Setting(_choice(*WRITE_DISPOSITIONS), default="merge"),
    "soft_delete": Setting(_choice(*SOFT_DELETE_MODES, off=True)),
    "endpoint": Setting(_table, default={}),
    "incremental": Setting(_table, default={}),
    "timestamp_columns": Setting(_names, default=()),
    "hint_columns": Setting(_names),
    "promote": Setting(_table, default={}),
    "html_text": Setting(_table, default={}),
    "exclude_columns": Setting(_names, default=()),
}
FRESHNESS: Block = {
    "table": Setting(_text, True),
    "column": Setting(_text, True),
    "hours": Setting(_number(int), default=DEFAULT_FRESHNESS_HOURS),
    "severity": Setting(_text, default="warn"),
}
EDGE: Block = {
    "child": Setting(_column, True),
    "parent": Setting(_column, True),
    "severity": Setting(_severity, default="error"),
}
QUALITY: Block = {
    "required": Setting(_names, default=()),
    "freshness": Setting(_table),
    "max_deleted_fraction": Setting(_number(float), default=DEFAULT_MAX_DELETED_FRACTION),
    "references": Setting(_list, default=[]),
    "not_null": Setting(_name_lists, default={}),
}
CONTRACT: Block = {
    "name": Setting(_text, True),
    "display_name": Setting(_text),
    "docs_url": Setting(_text),
    "api": Setting(_table, True),
    "rate_limits": Setting(_table, default={}),
    "orchestration": Setting(_table, default={}),
    "resources": Setting(_list, True),
    "pagination": Setting(_table, default={}),
    "quality": Setting(_table, default={}),
    "extensions": Setting(_text),
}
# Blocks that others may add settings to: read for what is known, not closed.
_OPEN = (API, AUTH, INCREMENTAL, FRESHNESS, EDGE)


class _Reading:
    """One pass over a contract: values out, problems gathered."""

    def __init__(self) -> None:
        self.problems: list[str] = []

    def complain(self, place: str, what: str) -> None:
        self.problems.append(f"{place}: {what}")

    def block(self, place: str, given: Any, settings: Block) -> dict[str, Any]:
        """Every setting of a block, by name; what can't be read is its default."""
        if not isinstance(given, Mapping):
            self.complain(place, f"should be a mapping, not {given!r}")
            given = {}
        elif settings not in _OPEN:
            for stray in sorted(map(str, set(given) - set(settings))):
                self.complain(place, f"{stray!r} is no setting here")
        return {name: self.value(f"{place}.{name}", given.get(name), setting)
                for name, setting in settings.items()}

    def value(self, place: str, given: Any, setting: Setting) -> Any:
        empty = given is None or given == "" or setting.needed and not given
        if empty:
            if setting.needed:
                self.complain(place, "is needed")
            return setting.default
        try:
            return setting.read(given)
        except ValueError as wanted:
            self.complain(place, f"{given!r} should be {wanted}")
            return setting.default

    def finish(self) -> None:
        if self.problems:
            raise ContractError("\n".join(self.problems))


@dataclass(frozen=True)
class Reference:
    """A declared edge: every non-null child value exists in the parent column."""

    child_table: str
    child_column: str
    parent_table: str
    parent_column: str
    severity: str = "error"


@dataclass(frozen=True)
class Freshness:
    table: str
    column: str
    hours: int = DEFAULT_FRESHNESS_HOURS
    severity: str = "warn"


@dataclass(frozen=True)
class Quality:
    required: tuple[str, ...] = ()
    freshness: Freshness | None = None
    max_deleted_fraction: float = DEFAULT_MAX_DELETED_FRACTION
    references: tuple[Reference, ...] = ()
    not_null: Mapping[str, tuple[str, ...]] = field(default_factory=dict)


@dataclass(frozen=True)
class Resource:
    """One table: its key, how it is fetched and how a record becomes a row."""

    name: str
    primary_key: tuple[str, ...]
    write_disposition: str = "merge"
    soft_delete: str | None = None
    strategy: str = "full_refresh"
    parent: str | None = None
    cursor_field: str | None = None
    lookback_seconds: int = 0
    # What to do with rows without a cursor: None leaves it to the strategy.
    cursor_missing: str | None = None
    # Where the first run of all starts.
    initial_value: datetime | None = None
    # A collection of which only the last months are read, by this field.
    window_field: str | None = None
    window_months: int | None = None
    endpoint: Mapping[str, Any] = field(default_factory=dict)
    timestamp_columns: tuple[str, ...] = ()
    hint_columns: tuple[str, ...] = ()
    promote: Mapping[str, str] = field(default_factory=dict)
    html_text: Mapping[str, str] = field(default_factory=dict)
    exclude_columns: tuple[str, ...] = ()

    @property
    def family(self) -> str:
        """The request budget this table's endpoint belongs to."""
        return self.endpoint.get("family") or self.name

    @property
    def route(self) -> str:
        return self.endpoint.get("path", f"/{self.name}")

    @property
    def requested_fields(self) -> tuple[str, ...] | None:
        """Fields the endpoint is asked for by name; None means everything."""
        params = self.endpoint.get("params") or {}
        for word in ("fields", "include"):
            if wanted := params.get(word):
                listed = wanted.split(",") if isinstance(wanted, str) else wanted
                return tuple(name.strip() for name in listed)
        return None


@dataclass(frozen=True)
class Contract:
    name: str
    resources: tuple[Resource, ...]
    quality: Quality = field(default_factory=Quality)
    pagination: Mapping[str, Any] = field(default_factory=dict)
    orchestration: Mapping[str, Any] = field(default_factory=dict)

    @classmethod
    def from_dict(cls, document: Any) -> Contract:
        reading = _Reading()
        told = reading.block("contract", document, CONTRACT)
        if told["api"]:
            api = reading.block("contract.api", told["api"], API)
            if api["auth"]:
                reading.block("contract.api.auth", api["auth"], AUTH)
        resources = tuple(_resource(reading, i, entry) for i, entry in enumerate(told["resources"] or ()))
        quality = _quality(reading, told["quality"])
        _judge_tables(reading, resources, quality)
        reading.finish()
        return cls(told["name"], resources, quality, told["pagination"], told["orchestration"])

    @property
    def dataset(self) -> str:
        """The database the tables land in: derived from the name, never set."""
        return f"raw_{self.name}"

    @property
    def backfill_start(self) -> str | None:
        return self.orchestration.get("backfill_start")

    @property
    def by_name(self) -> dict[str, Resource]:
        return {resource.name: resource for resource in self.resources}

    @property
    def resource_names(self) -> tuple[str, ...]:
        return tuple(self.by_name)

    def resource(self, name: str) -> Resource:
        return self._named([name])[0]

    def select(self, names: str) -> tuple[Resource, ...]:
        """Resources of a comma list, in its order, or of ``all``."""
        if names.strip() == "all":
            return self.resources
        return self._named([part for part in map(str.strip, names.split(",")) if part])

    def _named(self, names: list[str]) -> tuple[Resource, ...]:
        known = self.by_name
        if strangers := [name for name in names if name not in known]:
            raise ContractError(
                f"{self.name} knows no table {', '.join(strangers)}, only {', '.join(known)}")
        return tuple(known[name] for name in names)


def _resource(reading: _Reading, place: int, entry: Any) -> Resource:
    called = entry.get("name", place) if isinstance(entry, Mapping) else place
    where = f"resources.{called}"
    told = reading.block(where, entry, RESOURCE)
    incremental = reading.block(f"{where}.incremental", told.pop("incremental"), INCREMENTAL)
    # An endpoint may stand beside the strategy or under it; the first counts.
    told |= incremental | {"endpoint": told["endpoint"] or incremental["endpoint"]}
    if told["hint_columns"] is None:
        told["hint_columns"] = told["timestamp_columns"]
    return Resource(**told)


def _quality(reading: _Reading, given: Any) -> Quality:
    told = reading.block("quality", given, QUALITY)
    if told["freshness"] is not None:
        told["freshness"] = Freshness(**reading.block("quality.freshness", told["freshness"], FRESHNESS))
    edges = [reading.block(f"quality.references.{i}", edge, EDGE) for i, edge in enumerate(told["references"])]
    told["references"] = tuple(
        Reference(*edge["child"], *edge["parent"], edge["severity"])
        for edge in edges if edge["child"] and edge["parent"])
    return Quality(**told)


def read_in_part(resource: Resource) -> str | None:
    """Why a run of this table never sees all of it; None if a run does."""
    if resource.strategy == "search_window":
        return "search_window returns what changed"
    if resource.window_field is not None:
        return "a rolling window returns its last months only"
    if resource.strategy == "parent_watermark":
        return "parent_watermark returns the children of changed parents"
    if resource.strategy == "parent_fanout" and resource.cursor_field:
        return "a cursor returns the children that changed"
    return None


def _judge_tables(reading: _Reading, resources: tuple[Resource, ...], quality: Quality) -> None:
    """What no block can tell by itself: names used twice, edges and parents that lead nowhere."""
    known = {resource.name: resource for resource in resources}
    for name, times in Counter(resource.name for resource in resources).items():
        if times > 1:
            reading.complain(f"resources.{name}", f"stands here {times} times")
    for edge in quality.references:
        for table in {edge.child_table, edge.parent_table} - set(known):
            reading.complain("quality.references", f"no table is called {table!r}")
    for resource in resources:
        if resource.soft_delete == "always" and (partial := read_in_part(resource)):
            reading.complain(f"resources.{resource.name}.soft_delete", f"{partial}, so absence from it means nothing")
        if (resource.window_field is None) != (resource.window_months is None):
            reading.complain(f"resources.{resource.name}.incremental",
                             "window_field and window_months go together")
        passed, parent = {resource.name}, resource.parent
        while parent is not None:
            if parent not in known:
                reading.complain(f"resources.{resource.name}.incremental.parent",
                                 f"no table is called {parent!r}")
                break
            if parent in passed:
                reading.complain(f"resources.{resource.name}.incremental.parent",
                                 f"{parent!r} is its own ancestor")
                break
            passed.add(parent)
            parent = known[parent].parent


@dataclass(frozen=True)
class RunWindow:
    """What one run covers. ``incremental`` runs have no bounds."""

    mode: str
    start: datetime | None = None
    end: datetime | None = None
    end_is_current: bool = False


def run_window(
    run_started_at: datetime,
    mode: str | None = None,
    start: datetime | None = None,
    end: datetime | None = None,
) -> RunWindow:
    """The window of a run: from ``start`` to ``end``, by default to now; without bounds if incremental."""
    bounded = start is not None
    if mode is None:
        mode = "window" if bounded else "incremental"
    if mode not in ("incremental", "window"):
        raise ContractError(f"a run is incremental or a window, not {mode!r}")
    if mode == "incremental":
        if bounded or end is not None:
            raise ContractError("an incremental run takes neither start nor end")
        return RunWindow(mode)
    until = run_started_at if end is None else end
    if not bounded or start >= until:
        raise ContractError(f"a window runs forward: from {start} to {until} it does not")
    return RunWindow(mode, start, until, end_is_current=run_started_at - until <= CURRENT_WITHIN)
