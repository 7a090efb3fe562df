"""Versions of partitioned tables that several writes publish as one.

A job writes each table's new partitions into folders of its own, ``.../commit=<token>`` below
the partition, and touches nothing that is already there. When all of them are written it adds
one entry to the log of the layer: for every table the version that holds each partition, or
none for a partition that was dealt with and has no rows. Readers resolve the last entry, so
they see all tables of a job or none of it; a job that stops before its entry has changed
nothing, and what it left behind is removed by ``vacuum``. An entry is one small file that
appears by a rename; a log has one writer at a time, and a second one's rename fails.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from clickweir.sources import files

Key = tuple
VERSION = "commit"
# Readers name so many folders at most; beyond, the planner prunes the listed tree.
NAMED_FOLDERS = 32


def new_token() -> str:
    return uuid.uuid4().hex[:16]


def _folder(by: list[str], key: Key, token: str) -> str:
    steps = [f"{name}={value:02d}" if name == "month" else f"{name}={value}" for name, value in zip(by, key, strict=True)]
    return "/".join([*steps, f"{VERSION}={token}"])


class CommitLog:
    """The log of a layer's tables, below ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def _entries(self) -> list[str]:
        return files.glob(self.spark, f"{self.root}/_commits/*.json")

    def snapshot(self) -> dict[str, dict[Key, str | None]]:
        """For each table the version of every partition dealt with, None for an empty one."""
        entries = self._entries()
        if not entries:
            return {}
        tables = json.loads(files.read_text(self.spark, entries[-1]))
        return {name: {tuple(key): token for *key, token in rows} for name, rows in tables.items()}

    def publish(self, changes: dict[str, dict[Key, str | None]]) -> None:
        """The new versions of some partitions of some tables, all at once."""
        tables, entries = self.snapshot(), self._entries()
        for name, keys in changes.items():
            tables.setdefault(name, {}).update(keys)
        number = int(entries[-1].rsplit("/", 1)[1].split(".")[0]) + 1 if entries else 0
        text = json.dumps({name: [[*key, token] for key, token in keys.items()] for name, keys in tables.items()})
        draft = f"{self.root}/_commits/_{new_token()}"
        files.write_text(self.spark, draft, text)
        files.rename(self.spark, draft, f"{self.root}/_commits/{number:010d}.json")

    def partitions(self, table: str, filled: bool = False) -> list[Key]:
        """Partitions dealt with; ``filled``: those with rows."""
        found = self.snapshot().get(table, {})
        return sorted(key for key, token in found.items() if token or not filled)

    def read(self, table: str, layout: StructType, by: list[str], keys: list[Key] | None = None) -> DataFrame:
        """The published rows of a table, of the given partitions or all."""
        found = {key: token for key, token in self.snapshot().get(table, {}).items() if token}
        if keys is not None:
            found = {key: found[key] for key in keys if key in found}
        if not found:
            return self.spark.createDataFrame([], layout)
        path = f"{self.root}/{table}"
        versioned = StructType([*layout.fields]).add(VERSION, StringType())
        reader = self.spark.read.schema(versioned).option("basePath", path)
        if len(found) <= NAMED_FOLDERS:
            rows = reader.parquet(*(f"{path}/{_folder(by, key, token)}" for key, token in found.items()))
        else:
            place = F.concat_ws("/", *by, VERSION)
            rows = reader.parquet(path).filter(place.isin(["/".join(map(str, [*key, token])) for key, token in found.items()]))
        return rows.select(*layout.names)

    def read_version(self, table: str, layout: StructType, by: list[str], token: str) -> DataFrame:
        """What has been written as one version, published or not."""
        path = f"{self.root}/{table}"
        folders = files.glob(self.spark, path + "".join(f"/{name}=*" for name in by) + f"/{VERSION}={token}")
        if not folders:
            return self.spark.createDataFrame([], layout)
        return self.spark.read.schema(layout).option("basePath", path).parquet(*folders).select(*layout.names)

    def write(self, df: DataFrame, table: str, by: list[str], token: str, handled: list[Key], sort_by: tuple[str, ...] = ()) -> dict[Key, str | None]:
        """Write ``df`` as a version, unpublished; returns what there is to publish.

        The rows are the whole new content of the partitions ``handled``.
        """
        rows = df.hint("rebalance", *by)
        if "month" in by:
            rows = rows.withColumn("month", F.lpad(F.col("month").cast("string"), 2, "0"))
        path = f"{self.root}/{table}"
        (
            rows.withColumn(VERSION, F.lit(token)).sortWithinPartitions(*by, *sort_by)
            .write.mode("append").option("compression", "zstd").partitionBy(*by, VERSION).parquet(path)
        )
        pattern = path + "".join(f"/{name}=*" for name in by) + f"/{VERSION}={token}"
        filled = set(files.glob(self.spark, pattern))
        root = files.qualified(self.spark, path)
        return {key: token if f"{root}/{_folder(by, key, token)}" in filled else None for key in handled}

    def vacuum(self, tables: dict[str, list[str]]) -> None:
        """Remove versions and entries that the last entry does not use. No reader may be at them."""
        now, entries = self.snapshot(), self._entries()
        for table, by in tables.items():
            root = files.qualified(self.spark, f"{self.root}/{table}")
            used = {f"{root}/{_folder(by, key, token)}" for key, token in now.get(table, {}).items() if token}
            for folder in files.glob(self.spark, root + "".join(f"/{name}=*" for name in by) + f"/{VERSION}=*"):
                if folder not in used:
                    files.delete(self.spark, folder)
        for entry in entries[:-1]:
            files.delete(self.spark, entry)
