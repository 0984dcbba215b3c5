"""Builds published whole: tables staged in a folder of the build, made visible
by one commit, read by bound name.

A store is a folder with ``builds/<build>/<table>`` and ``commits/<number>``.
A commit is one small file that names a build and its tables; it is created
only if it is not there, so of two writers one wins, and a reader sees the last
commit or the one before, never half a build.  What is staged without a commit
is not visible.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from tessera.session import scratch_table


class Store:
    def __init__(self, spark: SparkSession, root: str, fmt: str = "parquet") -> None:
        self.spark, self.root, self.fmt = spark, root.rstrip("/"), fmt

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    # --- writing ---------------------------------------------------------------
    def stage(self, build: str | None = None) -> str:
        """A new build's folder; nobody reads it before it is published."""
        return f"{self.root}/builds/{build or uuid.uuid4().hex}"

    def publish(self, folder: str, tables: list[str]) -> int:
        """Make the build in ``folder`` the current one; its number.  Every
        table must be whole (Spark's own commit marker is looked for)."""
        for t in tables:
            fs, marker = self._fs(f"{folder}/{t}/_SUCCESS")
            if not fs.exists(marker):
                raise ValueError(f"{t} is not written whole in {folder}")
        number = max(self.versions(), default=0) + 1
        fs, path = self._fs(f"{self.root}/commits/{number:08d}.json")
        text = json.dumps({"folder": folder, "tables": sorted(tables)})
        # written aside and renamed, which fails if the name is taken: no reader sees half of it
        aside = self._fs(f"{self.root}/commits/.{uuid.uuid4().hex}")[1]
        out = fs.create(aside, False)
        out.write(bytearray(text.encode()))
        out.close()
        if fs.exists(path) or not fs.rename(aside, path):
            fs.delete(aside, False)
            raise RuntimeError(f"build {number} was published by another writer meanwhile")
        return number

    # --- reading ---------------------------------------------------------------
    def versions(self) -> list[int]:
        fs, path = self._fs(f"{self.root}/commits")
        names = [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and not n.startswith("."))

    def _commit(self, version: int | None) -> dict:
        versions = self.versions()
        if not versions or version is not None and version not in versions:
            raise LookupError(f"no published build {'' if version is None else version} in {self.root}")
        path = f"{self.root}/commits/{version or versions[-1]:08d}.json"
        return json.loads("".join(r["value"] for r in self.spark.read.text(path).collect()))

    def tables(self, version: int | None = None) -> dict[str, DataFrame]:
        """The tables of one published build (the last by default), all of the same one."""
        commit = self._commit(version)
        return {t: self.spark.read.format(self.fmt).load(f"{commit['folder']}/{t}") for t in commit["tables"]}

    def register(self, prefix: str, version: int | None = None) -> dict[str, str]:
        """Catalog tables ``prefix_<table>`` on one published build: the names
        by logical name, for ``bound``."""
        commit, names = self._commit(version), {}
        for t in commit["tables"]:
            names[t] = f"{prefix}_{t}"
            self.spark.sql(f"DROP TABLE IF EXISTS {names[t]}")
            self.spark.catalog.createTable(names[t], f"{commit['folder']}/{t}", self.fmt)
            scratch_table(self.spark, names[t])
        return names


def bound(spark: SparkSession, names: Mapping[str, str]) -> dict[str, DataFrame]:
    """Catalog tables by the logical names that models read."""
    return {logical: spark.table(physical) for logical, physical in names.items()}
