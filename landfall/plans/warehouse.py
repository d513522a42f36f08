"""Where landed tables live, and how a load becomes visible.

A table is a plain Parquet folder. A load is staged whole, entered in the ledger
as prepared, switched in, and entered as committed, in that order. Switching
only replaces folders with staged copies, so doing it again after a crash gives
the same table. One run per source at a time; its tables may land side by side.

Merged tables are laid out in hash buckets of the key. A load rewrites the
buckets it has rows for and reads no others. A bucket is one task of the merge,
so choose their number such that one holds a gigabyte or a few; it is part of
the partition column's name, so a table cannot be written under two layouts.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from landfall.operators.incremental import cursor_state, pending_loads
from landfall.operators.merge import dedup_latest, merge_upsert, settle_types
from landfall.operators.ranges import RANGES_SCHEMA, covered_until
from landfall.operators.shape import LOAD_ID
from landfall.operators.tombstone import is_stale, mark_deleted
from landfall.sources.tables import ensure_database

PRODUCTION = "production"
LEDGER_SCHEMA = (
    "table_name string, load_id string, disposition string, state string, place bigint"
)
STATE_SCHEMA = (
    "source string, resource string, destination string, cursor timestamp, "
    "load_id string, saved_at timestamp"
)


@dataclass(frozen=True)
class Warehouse:
    root: str
    source: str
    buckets: int = 64
    destination: str = PRODUCTION

    @property
    def dataset(self) -> str:
        return f"raw_{self.source}"

    @property
    def base(self) -> str:
        """A rehearsal has its own tables, ledger and cursors."""
        if self.destination == PRODUCTION:
            return f"{self.root}/{self.dataset}"
        return f"{self.root}/_rehearsal/{self.destination}/{self.dataset}"

    @property
    def bucket(self) -> str:
        return f"_bucket_of_{self.buckets}"

    def path(self, table: str) -> str:
        return f"{self.base}/{table}"

    def _staged(self, table: str, load_id: str, part: str) -> str:
        return f"{self.base}/_staged/{table}/{load_id}/{part}"

    # ── reading ──────────────────────────────────────────────────────────────

    def _rows(self, spark: SparkSession, table: str) -> DataFrame | None:
        """The table under its recorded schema, so that no footers are gathered to
        find columns only some buckets have yet."""
        schema = self.schema(spark, table)
        return None if schema is None else read_if_present(spark, self.path(table), schema)

    def schema(self, spark: SparkSession, table: str) -> T.StructType | None:
        recorded = read_if_present(spark, f"{self.base}/_schema/{table}")
        return None if recorded is None else recorded.schema

    def read(self, spark: SparkSession, table: str) -> DataFrame | None:
        """The table's rows; None if nothing ever landed in it."""
        rows = self._rows(spark, table)
        return None if rows is None else rows.drop(self.bucket)

    def read_all(
        self, spark: SparkSession, tables: Sequence[str]
    ) -> dict[str, DataFrame | None]:
        return {table: self.read(spark, table) for table in tables}

    def ledger(self, spark: SparkSession, table: str = "*") -> DataFrame:
        return _log(spark, f"{self.base}/_ledger/{table}", LEDGER_SCHEMA)

    def is_committed(self, spark: SparkSession, table: str, load_id: str) -> bool:
        return self._history(spark, table, load_id)[1]

    def _history(
        self, spark: SparkSession, table: str, load_id: str | None = None
    ) -> tuple[str | None, bool]:
        """How the table is written, None before its first load, and whether the
        load is committed."""
        is_it = (F.col("load_id") == load_id) & (F.col("state") == "committed")
        entries = (
            self.ledger(spark, table).groupBy("disposition").agg(F.bool_or(is_it)).collect()
        )
        written = [entry[0] for entry in entries if entry[0] != "tombstone"]
        return (written[0] if written else None), any(entry[1] for entry in entries)

    def _layout(self, disposition: str | None) -> list[str]:
        """The columns a table's folders are named by."""
        return {"merge": [self.bucket], "append": [LOAD_ID]}.get(disposition, [])

    # ── landing ──────────────────────────────────────────────────────────────

    def land(
        self,
        table: str,
        rows: DataFrame,
        keys: Sequence[str],
        load_id: str,
        disposition: str = "merge",
        cursor: str | None = None,
        told: dict | None = None,
    ) -> DataFrame:
        """Land one load; returns its rows as staged. A load id that is already
        committed lands nothing again. ``told`` is filled with what the staging write counted on
        its way: ``rows``, the ``newest`` cursor, and ``keyless`` rows, which no merge finds again."""
        spark = rows.sparkSession
        # A load that was lost on its way must not be replayed over this one later.
        self.recover(spark, table)
        delta_path = self._staged(table, load_id, "delta")
        before, committed = self._history(spark, table, load_id)
        if before not in (None, disposition):
            raise ValueError(f"{table} is a table of {before} loads, not {disposition}")
        if committed:
            staged = spark.read.parquet(delta_path).drop(self.bucket)
            _tell(told, staged.agg(*_metrics(staged, keys, cursor)).first().asDict())
            return staged
        if disposition == "append":
            delta = rows
        else:
            delta = dedup_latest(rows, keys, cursor)
        known = self.schema(spark, table)
        if disposition == "merge":
            delta = self._keyed_as_before(delta, known, keys)
        if disposition != "replace" and known is not None:
            delta = settle_types(delta, known)
        if disposition == "merge":
            delta = delta.withColumn(self.bucket, self._bucket_of(keys))
        seen = Observation()
        delta.observe(seen, *_metrics(delta, keys, cursor)).write.mode("overwrite").parquet(delta_path)
        counted = _tell(told, seen.get)
        staged = spark.read.schema(delta.schema).parquet(delta_path)
        if disposition == "merge" and counted["rows"]:
            self._stage_merge(spark, table, staged, keys, load_id)
        self._prepare(spark, table, load_id, disposition)
        self._switch(spark, table, load_id, disposition)
        return staged.drop(self.bucket)

    def _keyed_as_before(
        self, rows: DataFrame, known: T.StructType | None, keys: Sequence[str]
    ) -> DataFrame:
        """Keys in the types the table knows them by, so that they hash alike. A key
        that does not fit raises."""
        if known is None:
            return rows
        return rows.withColumns({key: F.col(key).cast(known[key].dataType) for key in keys})

    def _bucket_of(self, keys: Sequence[str]) -> Column:
        # The number of the task that Spark hashes these keys to among as many tasks
        # as there are buckets.
        return F.pmod(F.hash(*keys), F.lit(self.buckets)).cast("int")

    def _stage_merge(self, spark, table, staged, keys, load_id) -> None:
        """Target and load move once, each bucket to its own task, where the join and
        the write both find it."""
        delta = staged.repartition(self.buckets, *keys)
        target = self._rows(spark, table)
        merged = delta
        if target is not None:
            touched = target.filter(F.col(self.bucket).isin(self._touched(staged)))
            merged = merge_upsert(
                touched.repartition(self.buckets, *keys), delta, keys, unique_delta=True,
                load_id=load_id,
            )
        self._write_parts(merged, self._staged(table, load_id, "result"), [self.bucket])

    def _touched(self, rows: DataFrame) -> list[int]:
        """Bucket numbers of a load: never more than there are buckets."""
        return [row[0] for row in rows.select(self.bucket).distinct().collect()]

    def _write_parts(self, rows: DataFrame, path: str, by: Sequence[str]) -> None:
        rows.write.mode("overwrite").partitionBy(*by).parquet(path)

    def _switch(self, spark, table, load_id, disposition) -> None:
        """Replace folders with their staged copies, then commit."""
        part = "result" if disposition in ("merge", "tombstone") else "delta"
        staged = read_if_present(spark, self._staged(table, load_id, part))
        if staged is not None:
            written = disposition
            if disposition == "tombstone":
                written = self._history(spark, table)[0]
            by = self._layout(written)
            self._record_schema(spark, table, staged, disposition)
            writer = staged.write.mode("overwrite")
            if by:
                writer = writer.partitionBy(*by).option("partitionOverwriteMode", "dynamic")
            writer.parquet(self.path(table))
        self._enter(spark, table, load_id, disposition, "committed")

    def _record_schema(self, spark, table, staged, disposition) -> None:
        known = self.schema(spark, table)
        columns = spark.createDataFrame([], staged.schema)
        if disposition != "replace" and known is not None:
            before = spark.createDataFrame([], known)
            columns = before.unionByName(columns, allowMissingColumns=True)
        if columns.schema != known:
            columns.coalesce(1).write.mode("overwrite").parquet(f"{self.base}/_schema/{table}")

    def _prepare(self, spark, table, load_id, disposition) -> None:
        last = self.ledger(spark, table).agg(F.max("place")).first()[0]
        self._enter(spark, table, load_id, disposition, "prepared", (last or 0) + 1)

    def _enter(self, spark, table, load_id, disposition, state, place=None) -> None:
        if place is None:       # a later state of a load keeps its place
            mine = self.ledger(spark, table).filter(F.col("load_id") == load_id)
            place = mine.agg(F.max("place")).first()[0]
        entry = [(table, load_id, disposition, state, place)]
        spark.createDataFrame(entry, LEDGER_SCHEMA).coalesce(1).write.mode("append").parquet(
            f"{self.base}/_ledger/{table}"
        )

    def recover(self, spark: SparkSession, table: str = "*") -> list[tuple[str, str]]:
        """Finish loads that were prepared but not committed, in the order they were
        prepared. Their ids are not part of the run that finds them. A load older than
        its table's last commit is given up: replaying it would undo the newer one."""
        ledger = self.ledger(spark, table)
        done = ledger.filter(F.col("state") != "prepared")
        last = done.filter("state = 'committed'").groupBy("table_name").agg(
            F.max("place").alias("last"))
        found = pending_loads(ledger.filter(F.col("state") == "prepared"), done).distinct().join(
            last, "table_name", "left").orderBy("place", "table_name").collect()
        finished = []
        for entry in found:
            if entry.last is not None and entry.place < entry.last:
                self._enter(spark, entry.table_name, entry.load_id, entry.disposition, "superseded")
                continue
            self._switch(spark, entry.table_name, entry.load_id, entry.disposition)
            finished.append((entry.table_name, entry.load_id))
        return finished

    # ── tombstones ───────────────────────────────────────────────────────────

    def mark_deleted(
        self, spark: SparkSession, tables: Sequence[str], load_ids: Sequence[str]
    ) -> dict[str, int]:
        """Flag stale rows per table and report how many. Only folders that hold
        stale rows are rewritten; a table without any is not written at all."""
        if not load_ids:
            return {}
        marked = {}
        for table in tables:
            rows = self._rows(spark, table)
            if rows is None:
                marked[table] = 0
                continue
            by = self._layout(self._history(spark, table)[0])
            stale = rows.filter(is_stale(load_ids))
            marked[table] = stale.count()
            if marked[table]:
                held = rows
                if by:      # an append table has a folder for each load that ever landed
                    held = rows.join(stale.select(*by).distinct(), by, "left_semi")
                load_id = f"{load_ids[-1]}-deleted"
                self._write_parts(
                    mark_deleted(held, load_ids), self._staged(table, load_id, "result"), by
                )
                self._prepare(spark, table, load_id, "tombstone")
                self._switch(spark, table, load_id, "tombstone")
        return marked

    # ── cursors ──────────────────────────────────────────────────────────────

    def cursor(self, spark: SparkSession, resource: str) -> datetime | None:
        states = _log(spark, f"{self.base}/_state/{resource}", STATE_SCHEMA)
        mine = states.filter(
            (F.col("source") == self.source) & (F.col("destination") == self.destination)
        )
        newest = cursor_state(mine).first()
        return newest.cursor if newest else None

    def save_cursor(
        self, spark: SparkSession, resource: str, cursor: datetime, load_id: str,
        saved_at: datetime,
    ) -> None:
        """Written after its data: a cursor that lags only merges again, one that
        leads loses rows."""
        state = [(self.source, resource, self.destination, cursor, load_id, saved_at)]
        spark.createDataFrame(state, STATE_SCHEMA).coalesce(1).write.mode("append").parquet(
            f"{self.base}/_state/{resource}"
        )

    def save_range(
        self, spark: SparkSession, resource: str, start: datetime | None, end: datetime | None,
        newest: datetime | None, load_id: str, saved_at: datetime,
    ) -> None:
        """That the resource was read from ``start`` to ``end``; written after its data."""
        read = [(self.source, resource, self.destination, start, end, newest, load_id, saved_at)]
        spark.createDataFrame(read, RANGES_SCHEMA).coalesce(1).write.mode("append").parquet(
            f"{self.base}/_ranges/{resource}"
        )

    def covered(self, spark: SparkSession, resource: str, floor: datetime) -> datetime | None:
        """The newest moment known without a gap from the floor on; None without any range."""
        log = _log(spark, f"{self.base}/_ranges/{resource}", RANGES_SCHEMA)
        found = covered_until(log, ["source", "resource", "destination"], floor).first()
        return found.newest if found else None

    # ── catalog ──────────────────────────────────────────────────────────────

    def publish(self, spark: SparkSession, tables: Sequence[str]) -> None:
        """Make landed folders external tables of the source's database."""
        ensure_database(spark, self.dataset)
        for table in tables:
            schema, rows = self.schema(spark, table), self._rows(spark, table)
            if rows is None:
                continue
            name = f"`{self.dataset}`.`{table}`"
            if spark.catalog.tableExists(name) and spark.table(name).schema != schema:
                spark.sql(f"DROP TABLE {name}")
            by = self._layout(self._history(spark, table)[0])
            layout = f"PARTITIONED BY (`{by[0]}`)" if by else ""
            spark.sql(
                f"CREATE TABLE IF NOT EXISTS {name} ({schema.toDDL()}) USING parquet {layout} "
                f"LOCATION '{self.path(table)}'"
            )
            if by:
                spark.catalog.recoverPartitions(name)
            spark.catalog.refreshTable(name)


def _metrics(rows: DataFrame, keys: Sequence[str], cursor: str | None) -> list[Column]:
    keyless = F.lit(False)
    for key in keys:
        keyless = keyless | F.col(key).isNull()
    newest = F.max(F.col(cursor).cast("timestamp")) if cursor else F.max(F.lit(None).cast("timestamp"))
    return [F.count(F.lit(1)).alias("rows"), newest.alias("newest"), F.count_if(keyless).alias("keyless")]


def _tell(told: dict | None, counted: dict) -> dict:
    if told is not None:
        told.update(counted)
    return counted


def read_if_present(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None
) -> DataFrame | None:
    """A Parquet folder; None if it was never written."""
    try:
        reader = spark.read if schema is None else spark.read.schema(schema)
        return reader.parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def _log(spark: SparkSession, path: str, schema: str) -> DataFrame:
    found = read_if_present(spark, path, schema)
    return spark.createDataFrame([], schema) if found is None else found
