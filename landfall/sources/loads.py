"""Loads: tables and partitions that take effect all at once.

A load writes under ``loads/<id>`` of the warehouse, where no reader looks. When all of it is written and checked, one small
file names it and what it replaces (whole tables, or some partitions of a table), and from then on ``read_table`` reads
these from the load. That file appears by one rename, so a reader finds the old state or the new one.

``settle`` then moves the load's folders into their tables, where other readers find them too, and removes
the file. Each partition is taken from the load while it stands there and from the table afterwards, so
settling may be broken off at any point and be taken up again: the next load does so first. It
also removes what a load left behind that was broken off before it was published. One load at a time
is written to a warehouse.
"""

from collections.abc import Callable
from dataclasses import dataclass, field
from uuid import uuid4

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.types import StructType

from landfall.sources.files import children, delete, delete_if_empty, exists, move
from landfall.sources.writers import write_by_date, write_table

LOADS = "loads"
PENDING = "pending_load"
PENDING_SCHEMA = "load string, name string, part string, gone boolean"


def partitions_of(spark: SparkSession, path: str) -> list[str]:
    """The folders ``key=value`` of a table partitioned by one column."""
    return [name for name in children(spark, path) if "=" in name]


@dataclass
class Load:
    """What one run writes. ``write`` adds a table or partitions, ``publish`` makes them the warehouse's."""

    spark: SparkSession
    root: str
    id: str = field(default_factory=lambda: uuid4().hex)
    written: dict[str, tuple[StructType, list[str] | None]] = field(default_factory=dict)

    @property
    def folder(self) -> str:
        return f"{self.root}/{LOADS}/{self.id}"

    def scratch(self, df: DataFrame, name: str, key: str | None = None) -> DataFrame:
        """A table of the load's own that is never published."""
        where = f"{self.folder}/scratch"
        return write_table(df, where, name) if key is None else write_by_date(df, where, name, key, gather=False)

    def write(
        self,
        df: DataFrame,
        name: str,
        key: str | None = None,
        replaces: Callable[[str], bool] | None = None,
        gather: bool = True,
    ) -> DataFrame:
        """Write a table of the warehouse, read back from the load.

        It replaces the whole table, or with ``replaces`` the partitions that it has, and others whose value (as in
        the folder's name) satisfies the condition.
        """
        if key is None:
            done = write_table(df, self.folder, name)
        else:
            done = write_by_date(df, self.folder, name, key, gather)
        old = None
        if replaces is not None and exists(self.spark, f"{self.root}/{name}"):
            found = partitions_of(self.spark, f"{self.root}/{name}")
            old = [part for part in found if replaces(part.split("=", 1)[1])]
        self.written[name] = (df.schema, old)
        return done

    def whole(self, name: str) -> DataFrame:
        """A written table as it will be: the load's partitions and those of the table that stay."""
        schema, old = self.written[name]
        here = partitions_of(self.spark, f"{self.folder}/{name}")
        return _joined(self.spark, f"{self.root}/{name}", f"{self.folder}/{name}", schema, here, old)

    def partitions(self, name: str) -> list[str]:
        """The partitions that a written table will have, by listing folders alone."""
        _, old = self.written[name]
        here = partitions_of(self.spark, f"{self.folder}/{name}")
        stay = [] if old is None else set(partitions_of(self.spark, f"{self.root}/{name}")) - set(old)
        return sorted({*stay, *here})

    def publish(self, settled: bool = True) -> None:
        """Make all that was written the warehouse's, at once, and put it into place unless ``settled`` is False."""
        rows = []
        for name, (_, old) in self.written.items():
            if old is None:
                rows.append((self.id, name, "", False))
                continue
            here = partitions_of(self.spark, f"{self.folder}/{name}")
            rows += [(self.id, name, part, False) for part in here]
            rows += [(self.id, name, part, True) for part in sorted(set(old) - set(here))]
        delete(self.spark, f"{self.folder}/scratch")
        pointers = self.spark.createDataFrame(rows, PENDING_SCHEMA).coalesce(1)
        pointers.write.mode("overwrite").parquet(f"{self.root}/{PENDING}")
        if settled:
            settle(self.spark, self.root)

    def abandon(self) -> None:
        """Remove all that was written, and folders that were made for it alone."""
        delete(self.spark, self.folder)
        delete_if_empty(self.spark, f"{self.root}/{LOADS}")
        delete_if_empty(self.spark, self.root)


def pending(spark: SparkSession, root: str) -> list[Row]:
    """What the published load that is not in place yet replaces: a row for each table or partition of a month or so."""
    path = f"{root}/{PENDING}"
    return spark.read.schema(PENDING_SCHEMA).parquet(path).collect() if exists(spark, path) else []


def settle(spark: SparkSession, root: str) -> None:
    """Put a published load into place and remove what earlier ones left behind."""
    for row in pending(spark, root):
        at = f"/{row.part}" if row.part else ""
        table, new = f"{root}/{row.name}{at}", f"{root}/{LOADS}/{row.load}/{row.name}{at}"
        if row.gone:
            delete(spark, table)
        elif exists(spark, new):
            delete(spark, table)
            move(spark, new, table)
    delete(spark, f"{root}/{PENDING}")
    delete(spark, f"{root}/{LOADS}")


def _joined(
    spark: SparkSession, table: str, load: str, schema: StructType | str | None, here: list[str], replaced: list[str] | None
) -> DataFrame:
    """A table with the load's partitions ``here`` instead of its own, and without those ``replaced``."""
    if replaced is None:
        return _read(spark, load, schema)
    stay = sorted(set(partitions_of(spark, table)) - set(here) - set(replaced))
    if not stay:
        return _read(spark, load if exists(spark, load) else table, schema)
    if not here:
        return _read(spark, table, schema, stay)
    new = _read(spark, load, schema, here)
    return _read(spark, table, new.schema, stay).unionByName(new)


def _read(spark: SparkSession, path: str, schema: StructType | str | None, parts: list[str] = ()) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    if parts:
        return reader.option("basePath", path).parquet(*[f"{path}/{part}" for part in parts])
    return reader.parquet(path)


def read_table(spark: SparkSession, root: str, name: str, schema: StructType | str | None = None) -> DataFrame:
    """A table of the warehouse. A schema pins the types, those of partition keys too.

    Where a load is published and not in place yet, its tables and partitions come from there.
    """
    table = f"{root}/{name}"
    rows = [row for row in pending(spark, root) if row.name == name]
    if not rows:
        return _read(spark, table, schema)
    load = f"{root}/{LOADS}/{rows[0].load}/{name}"
    if not rows[0].part and len(rows) == 1:
        return _read(spark, load if exists(spark, load) else table, schema)
    named = {row.part for row in rows if not row.gone}
    here = [part for part in partitions_of(spark, load) if part in named]
    return _joined(spark, table, load, schema, here, [row.part for row in rows if row.gone])
