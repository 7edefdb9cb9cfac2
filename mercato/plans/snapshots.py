"""Versions of a published lake, and the one step that makes a version current.

A publish writes a whole new version and touches nothing of the ones before.
Then one step names it: in a folder, a manifest file that is renamed into its
place; in a catalog, one view with one row that every table's view reads.
Readers resolve that name once and see one whole version, before and after and
when a run is killed between any two steps.

Folder::

    <root>/versions/<version>/<layer>/<table>/        data, never changed
    <root>/_manifests/<number>.json                   version, tables, schemas, counters

The current version is that of the manifest with the highest number.  Two
publishes that begin from the same version want the same number; the rename
fails where the name is taken, so the second one stops and changes nothing.
A reader may hold on to a version until ``keep`` later ones have been made.

Catalog: a table ``<layer>_<table>_versions``, partitioned by version, and a view
``<layer>_<table>`` of the partition that ``current_version`` names.  The name is
a constant of that view, so the scan lists that partition only.

Silver tables are routed (``mercato.operators.expect.routed``): files are kept
apart by ``destino``, and the tables are what went to ``good``.  Files of a
folder may hold columns beside those of the table, for later tables of the same
publish; readers go by the manifest's schema and never see them.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.operators.expect import GOOD, MASK, QUARANTINE, ROUTE
from mercato.operators.manifests import Manifests

VERSION = "lake_version"


def _columns(schema: T.StructType, route: str | None) -> list[str]:
    return [f.name for f in schema.fields if f.name != ROUTE and (f.name != MASK or route == QUARANTINE)]


def _routed(df: DataFrame, schema: T.StructType, route: str | None) -> DataFrame:
    if ROUTE in schema.names:
        df = df.where(F.col(ROUTE) == (route or GOOD))
    return df.select(*[F.col(c).alias(c, metadata=schema[c].metadata) for c in _columns(schema, route)])


class FolderStore:
    """The versions under a folder of any Hadoop file system."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self.manifests = Manifests(spark, os.path.join(self.root, "_manifests"))
        self.fs = self.manifests.fs

    def _path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(os.path.join(self.root, *parts))

    def numbers(self) -> list[int]:
        """Committed versions, oldest first."""
        return self.manifests.numbers()

    def manifest(self, number: int | None = None) -> dict | None:
        """The manifest of a version, by default the current one's; None if there is none."""
        if number is None:
            if not (numbers := self.numbers()):
                return None
            number = numbers[-1]
        return self.manifests.read(number)

    def table(self, manifest: dict, name: str, route: str | None = None) -> DataFrame:
        """A table of a version, with the schema and comments it was written with."""
        schema = T.StructType.fromJson(manifest["schemas"][name])
        where = os.path.join(self.root, "versions", manifest["version"], *name.split("."))
        return _routed(self.spark.read.schema(schema).parquet(where), schema, route)

    def begin(self, buckets: int | None = None) -> FolderVersion:
        return FolderVersion(self, max(self.numbers(), default=0) + 1)

    def expire(self, keep: int) -> None:
        """Removes all but the last ``keep`` versions, and what killed runs left before them."""
        numbers = self.numbers()
        kept = numbers[-keep:]
        for n in numbers[:-keep]:
            self.manifests.remove(n)
        named = {self.manifest(n)["version"] for n in kept}
        folder = self._path("versions")
        for version in [f.getPath().getName() for f in self.fs.listStatus(folder)] if self.fs.exists(folder) else []:
            if kept and version not in named and int(version.split("-")[0]) <= kept[-1]:
                self.fs.delete(self._path("versions", version), True)


class FolderVersion:
    def __init__(self, store: FolderStore, number: int) -> None:
        self.store, self.number = store, number
        self.manifest = {"version": f"{number:08d}-{uuid.uuid4().hex[:12]}", "schemas": {}}
        self.written: dict[str, dict] = {}
        self.committed = False

    def write(self, df: DataFrame, name: str, bucket_by: str | None = None, beside: Sequence[str] = ()) -> DataFrame:
        """Writes a table, with the columns ``beside`` in its files; the table is returned without them."""
        self.written[name] = df.schema.jsonValue()
        schema = self.manifest["schemas"][name] = df.drop(*beside).schema.jsonValue()
        where = os.path.join(self.store.root, "versions", self.manifest["version"], *name.split("."))
        writer = df.write.partitionBy(ROUTE) if any(f["name"] == ROUTE for f in schema["fields"]) else df.write
        writer.option("compression", "zstd").parquet(where)
        return self.store.table(self.manifest, name)

    def whole(self, name: str) -> DataFrame:
        """A table that was written here, with the columns beside it."""
        return self.store.table({**self.manifest, "schemas": self.written}, name)

    def commit(self, metrics: dict) -> None:
        """Raises ``Conflict`` where another publish took the number that this one wanted."""
        self.store.manifests.commit(self.number, {**self.manifest, "metrics": metrics})
        self.committed = True

    def discard(self) -> None:
        self.store.fs.delete(self.store._path("versions", self.manifest["version"]), True)


class CatalogStore:
    """The versions in a database of the session's catalog."""

    def __init__(self, spark: SparkSession, database: str) -> None:
        self.spark, self.database = spark, database
        self.current = f"{database}.current_version"

    def _names(self) -> set[str]:
        return {t.name for t in self.spark.catalog.listTables(self.database)} if self.spark.catalog.databaseExists(self.database) else set()

    def manifest(self, version: str | None = None) -> dict | None:
        """The current version (or the one given); None if there is none."""
        if version is None:
            if "current_version" not in self._names():
                return None
            version = self.spark.table(self.current).first()["version"]
        return {"version": version} if version else None

    def table(self, manifest: dict, name: str, route: str | None = None) -> DataFrame:
        all_versions = self.spark.table(f"{self.database}.{name.replace('.', '_')}_versions")
        schema = T.StructType([f for f in all_versions.schema.fields if f.name != VERSION])
        return _routed(all_versions.where(F.col(VERSION) == manifest["version"]), schema, route)

    def begin(self, buckets: int | None = None) -> CatalogVersion:
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database}")
        now = self.manifest()
        return CatalogVersion(self, (int(now["version"].split("-")[0]) if now else 0) + 1, buckets)

    def expire(self, keep: int) -> None:
        now = self.manifest()
        if now is None:
            return
        last = int(now["version"].split("-")[0])
        self.drop(lambda v: (n := int(v.split("-")[0])) <= last - keep or (n == last and v != now["version"]))

    def drop(self, goes: Callable[[str], bool]) -> None:
        """Removes the partitions of versions for which ``goes`` holds."""
        for name in sorted(n for n in self._names() if n.endswith("_versions")):
            for p in self.spark.sql(f"SHOW PARTITIONS {self.database}.{name}").toLocalIterator():
                spec = dict(x.split("=", 1) for x in p["partition"].split("/"))
                if goes(spec[VERSION]):
                    values = ", ".join(f"{c} = '{v}'" for c, v in spec.items())
                    self.spark.sql(f"ALTER TABLE {self.database}.{name} DROP IF EXISTS PARTITION ({values})")


class CatalogVersion:
    def __init__(self, store: CatalogStore, number: int, buckets: int | None) -> None:
        self.store, self.number, self.buckets = store, number, buckets
        self.manifest = {"version": f"{number:08d}-{uuid.uuid4().hex[:12]}"}
        self.views: dict[str, T.StructType] = {}
        self.committed = False

    def write(self, df: DataFrame, name: str, bucket_by: str | None = None, beside: Sequence[str] = ()) -> DataFrame:
        """Writes a table, without the columns ``beside``: the tables of a catalog keep the columns they were made with."""
        df = df.drop(*beside)
        self.views[name] = df.schema
        parts = [VERSION, ROUTE] if ROUTE in df.columns else [VERSION]
        writer = df.withColumn(VERSION, F.lit(self.manifest["version"])).write.format("parquet").mode("append").partitionBy(*parts)
        if self.buckets and bucket_by:
            writer = writer.bucketBy(self.buckets, bucket_by).sortBy(bucket_by)
        writer.saveAsTable(f"{self.store.database}.{name.replace('.', '_')}_versions")
        return self.store.table(self.manifest, name)

    def whole(self, name: str) -> DataFrame:
        return self.store.table(self.manifest, name)

    def commit(self, metrics: dict) -> None:
        sql, db, current = self.store.spark.sql, self.store.database, self.store.current
        sql(f"CREATE VIEW IF NOT EXISTS {current} AS SELECT CAST(NULL AS STRING) AS version")
        for name, schema in self.views.items():
            table = f"{db}.{name.replace('.', '_')}"
            for view, route in [(table, GOOD), (f"{table}_{QUARANTINE}", QUARANTINE)] if ROUTE in schema.names else [(table, None)]:
                kept = f" AND {ROUTE} = '{route}'" if route else ""
                sql(f"CREATE VIEW IF NOT EXISTS {view} AS SELECT {', '.join(f'`{c}`' for c in _columns(schema, route))} FROM {table}_versions "
                    f"WHERE {VERSION} = (SELECT version FROM {current}){kept}")
        self._switch()
        self.committed = True

    def _switch(self) -> None:
        self.store.spark.sql(f"CREATE OR REPLACE VIEW {self.store.current} AS SELECT '{self.manifest['version']}' AS version")

    def discard(self) -> None:
        self.store.drop(lambda version: version == self.manifest["version"])
