"""Run a registered query and its SQL on the same files and compare the rows."""

import math
from pathlib import Path

import duckdb


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, (list, tuple)):
        return tuple(normal(item) for item in value)
    return value


def as_bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(normal(row[i]) for i in order) for row in rows), key=lambda row: repr(row)
    )


def oracle(sf_dir, sql):
    with duckdb.connect() as db:
        for path in Path(sf_dir).glob("*.parquet"):
            db.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
        found = db.execute(sql)
        columns = [column[0] for column in found.description]
        return sorted(columns), as_bag(columns, found.fetchall())


def spark_rows(df):
    return sorted(df.columns), as_bag(df.columns, [tuple(row) for row in df.collect()])


def difference(spark, sf_dir, build, sql):
    """None if they agree, otherwise what differs."""
    got_columns, got = spark_rows(build(spark, sf_dir))
    want_columns, want = oracle(sf_dir, sql)
    if got_columns != want_columns:
        return f"columns {got_columns} but SQL has {want_columns}"
    if got == want:
        return None
    mine, theirs = set(map(repr, got)) - set(map(repr, want)), set(map(repr, want)) - set(
        map(repr, got)
    )
    return (f"{len(got)} rows, SQL has {len(want)}; only here {sorted(mine)[:3]}; "
            f"only in SQL {sorted(theirs)[:3]}")
