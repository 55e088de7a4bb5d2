"""Named tables: ``dataset.table`` in the catalog, files under one root folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.functions.columns import qualified, quote, text_literal
from tidemark.sources.fs import Fs
from tidemark.sources.snapshot import SnapshotTable


class Warehouse:
    """Datasets are databases of the session catalog; each table's name is a view of its current
    version, replaced in one step by every commit."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._fs = Fs(spark, self.root)

    def create_dataset(self, dataset: str) -> None:
        location = text_literal(f"{self.root}/{dataset}")
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {quote(dataset)} LOCATION {location}")

    def table(self, name: str) -> SnapshotTable:
        dataset, table = self.split(name)
        return SnapshotTable(self.spark, f"{self.root}/{dataset}/{table}", name)

    @staticmethod
    def split(name: str) -> tuple[str, str]:
        parts = name.split(".")
        if len(parts) != 2 or not all(parts):
            raise ValueError(f"a table is named dataset.table, not {name!r}")
        return parts[0], parts[1]

    def frame(self, name: str) -> DataFrame:
        """A stored table, or anything else the catalog knows by this name."""
        if "." in name:
            stored = self.table(name)
            if stored.exists():
                return stored.read()
        return self.spark.table(name)

    def exists(self, name: str) -> bool:
        return self.table(name).exists() or self.spark.catalog.tableExists(name)

    def drop(self, name: str) -> None:
        """Remove a stored table with all its versions, and its name."""
        self.spark.sql(f"DROP VIEW IF EXISTS {qualified(name)}")
        path = self.table(name).path
        self._fs.delete(f"{path}/_versions")
        self._fs.delete(path)

    def stored_tables(self, dataset: str) -> list[str]:
        names = self._fs.names(f"{self.root}/{dataset}")
        return sorted(n for n in names if self.table(f"{dataset}.{n}").exists())

    def tables(self, dataset: str) -> list[str]:
        """Stored tables and plain catalog tables of a dataset; views are not tables."""
        found = set(self.stored_tables(dataset))
        if self.spark.catalog.databaseExists(dataset):
            found |= {
                t.name for t in self.spark.catalog.listTables(dataset)
                if t.tableType != "VIEW" and not t.isTemporary
            }
        return sorted(found)

    def publish(self, dataset: str) -> None:
        """Register the stored tables of a dataset in a session that did not write them."""
        self.create_dataset(dataset)
        for name in self.stored_tables(dataset):
            self.table(f"{dataset}.{name}").publish()
