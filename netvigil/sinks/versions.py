"""Published tables that readers never see half written.

Every refresh writes a folder of its own; a commit record, written last, names
the folders that are current. Readers follow the newest record, so a refresh that
ends midway changes nothing for them, and several tables change together. One
root has one publisher at a time. Folders that no recent record names can be
removed later, when no reader uses them any more.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netvigil.session import at_once
from netvigil.sources.flows import inline_rows
from netvigil.sources.versions import COMMIT_SCHEMA, COMMITS, commits, current


def stage(table: DataFrame, root: str, name: str) -> str:
    """Write a table to a new folder below ``root`` without showing it to readers."""
    folder = f"{name}/{uuid.uuid4().hex}"
    table.write.parquet(f"{root}/{folder}")
    return folder


def commit(spark: SparkSession, root: str, folders: dict[str, str]) -> int:
    """Make staged folders current, all at once. Tables that are not named stay as they are."""
    version, before = current(spark, root)
    listed = [{"name": name, "folder": folder} for name, folder in sorted((before | folders).items())]
    inline_rows(spark, [(version + 1, listed)], COMMIT_SCHEMA).coalesce(1).write.mode("append").json(f"{root}/{COMMITS}")
    return version + 1


def publish(tables: dict[str, DataFrame], root: str,
            manifest: tuple[str, Callable[[dict[str, DataFrame]], DataFrame]] | None = None) -> dict[str, DataFrame]:
    """Refresh several tables in one step; an empty one leaves its old version in place.

    ``manifest`` names a further table that is made from the refreshed ones and
    becomes current with them. Returns what was refreshed, as published.
    """
    if not tables:
        return {}
    spark = next(iter(tables.values())).sparkSession
    folders = dict(zip(tables, at_once(spark, lambda name: stage(tables[name], root, name), tables)))
    staged = {name: spark.read.parquet(f"{root}/{folder}") for name, folder in folders.items()}
    filled = {name: table for name, table in staged.items() if not table.isEmpty()}
    if filled and manifest is not None:
        name, make = manifest
        folders[name] = stage(make(filled), root, name)
        filled[name] = spark.read.parquet(f"{root}/{folders[name]}")
    if filled:
        commit(spark, root, {name: folders[name] for name in filled})
    return filled


def remove_old(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete the folders that only commits before the last ``keep`` name; returns them. Readers of those must be gone."""
    found = commits(spark, root)
    if found is None:
        return []
    by_age = found.orderBy(F.desc("version")).collect()  # one row per refresh
    named = lambda rows: {t.folder for row in rows for t in row.tables}
    stale = sorted(named(by_age[keep:]) - named(by_age[:keep]))
    for folder in stale:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{folder}")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return stale
