"""Tables as parquet folders: scans, appends, replacements, idempotent day refreshes.

All tables are partitioned by ``event_date``. A refresh rewrites only the days it has rows for and
gives the same table when it is started again.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourwatt.functions import times as TM
from hourwatt.operators.keys import latest_per_key
from hourwatt.schemas import KEYS, SCHEMAS
from hourwatt.sources.facts import FACTS, day_facts

DAY = "event_date"
CHANGE = "series_id string, event_date date"
FIRST = f"v{1:012d}"


def conform(df: DataFrame, table: str) -> DataFrame:
    """The declared columns in the declared order and types; absent ones become null."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in SCHEMAS[table]
        ]
    )


def since(df: DataFrame, start: Column, column: str = "timestamp_hour") -> DataFrame:
    """Rows from ``start`` on; also names the day column, so that older partitions are skipped."""
    df = df.where(F.col(column) >= start)
    return df.where(F.col(DAY) >= F.to_date(start)) if DAY in df.columns else df


class TableStore:
    """The five tables below one root folder; writers return how many rows they were given.

    With ``facts`` every write also brings the facts of the days it touched up to date, for checks that then
    read days and not rows.
    """

    def __init__(self, spark: SparkSession, root: str, facts: bool = False):
        self.spark = spark
        self.root = root.rstrip("/")
        self.keeps_facts = facts

    def versions(self, table: str) -> list[str]:
        """Complete versions of the table, oldest first: a folder each, marked when it was done."""
        files, path = self._hadoop(f"{self.root}/{table}")
        if not files.exists(path):
            return []
        names = [s.getPath().getName() for s in files.listStatus(path) if s.isDirectory()]
        done = [n for n in names if files.exists(self._hadoop(f"{self.root}/{table}/{n}/_SUCCESS")[1])]
        return sorted(n for n in done if n.startswith("v"))

    def path(self, table: str) -> str:
        """The newest version, or the place of the first one."""
        return f"{self.root}/{table}/{(self.versions(table) or [FIRST])[-1]}"

    def _hadoop(self, path: str):
        sc = self.spark.sparkContext
        found = sc._jvm.org.apache.hadoop.fs.Path(path)
        return found.getFileSystem(sc._jsc.hadoopConfiguration()), found

    def days(self, table: str) -> list[date]:
        """Days that the table has a folder for, newest first; taken from names, no file is read."""
        files, path = self._hadoop(self.path(table))
        names = [s.getPath().getName() for s in files.listStatus(path) if s.isDirectory()]
        found = [n.split("=", 1)[1] for n in names if n.startswith(f"{DAY}=")]
        return sorted((date.fromisoformat(d) for d in found if d[:1].isdigit()), reverse=True)

    def exists(self, table: str) -> bool:
        return bool(self.versions(table))

    def read(self, table: str, or_empty: bool = False) -> DataFrame:
        """The table with its ``event_date`` column.

        A table that was never written is an error, unless the caller takes no rows for it.
        """
        if not self.exists(table):
            if not or_empty:
                raise FileNotFoundError(f"no table {table} below {self.root}")
            return self.spark.createDataFrame([], _with_day(table))
        return self.spark.read.schema(_with_day(table)).parquet(self.path(table))

    def __getitem__(self, table: str) -> DataFrame:
        return self.read(table)

    def scan(
        self, table: str, columns: list[str], start: datetime | None = None
    ) -> DataFrame:
        df = self.read(table)
        if start is not None:
            df = since(df, TM.at(start))
        return df.select(*columns)

    def _by_day(self, df: DataFrame, table: str) -> DataFrame:
        df = conform(df, table).withColumn(DAY, F.to_date("timestamp_hour"))
        # Rebalancing splits a day that holds most rows and joins small days, before files are cut.
        return df.hint("rebalance", F.col(DAY)).sortWithinPartitions(DAY, *KEYS[table])

    def append(self, df: DataFrame, table: str) -> int:
        if not self.exists(table):
            return self.replace(df, table)
        with self._facts_follow(table, None) as written:
            return self._write(df, table, self.path(table), written)

    def replace(self, df: DataFrame, table: str) -> int:
        """Full rebuild as a new version, which counts from the moment its last file is written.

        Readers see the old version or the new one, never none. The version before stays for
        readers that have begun; older ones go.
        """
        have = self.versions(table)
        number = int(have[-1][1:]) + 1 if have else int(FIRST[1:])
        folder = f"{self.root}/{table}/v{number:012d}"
        files, unfinished = self._hadoop(folder)
        files.delete(unfinished, True)  # what a lost run left of the same version
        with self._facts_follow(table, None):
            rows = self._write(df, table, folder)
        for old in have[:-1]:
            files.delete(self._hadoop(f"{self.root}/{table}/{old}")[1], True)
        return rows

    def refresh(
        self, df: DataFrame, table: str, newest: str | None = None, noted: bool = False
    ) -> int:
        """Add rows, one per key: the largest ``newest`` wins, on a tie the new row.

        Only days that occur in ``df`` are read, and only those with a row that the table does not
        have yet (load times aside) are rewritten, so the same feed again rewrites nothing. ``df`` is
        computed once, into a staging folder. Spark writes all rewritten days first and then swaps
        them in one after the other: a reader in that moment may see some days old and some new.

        ``noted`` writes the series and days that change down before they do, for whoever keeps a
        table that depends on this one (``changes``); a lost run leaves its notes, and the next one
        finds them.
        """
        staged, rows = self._stage(df, table)
        new = self.spark.read.schema(_with_day(table)).parquet(staged)
        first, last = new.agg(F.min(DAY), F.max(DAY)).first()
        if first is not None:
            old = self.read(table, or_empty=True).where(F.col(DAY).between(F.lit(first), F.lit(last)))
            values = [f.name for f in SCHEMAS[table] if f.name != newest]
            have = old.select(*[F.col(c).alias(f"_{c}") for c in values])
            same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in values]
            changed = new.join(have, same, "left_anti").select("series_id", DAY).distinct()
            if noted:
                folder = f"{self.root}/_changes/{table}/{uuid.uuid4().hex}"
                changed.write.parquet(folder)
                changed = self.spark.read.schema(CHANGE).parquet(folder)
            days = [r[0] for r in changed.select(DAY).distinct().collect()]  # the days of one load
            if not days:
                files, path = self._hadoop(staged)
                files.delete(path, True)
                return rows
            new, old = (x.where(F.col(DAY).isin(days)) for x in (new, old))
            loaded = F.unix_micros(newest) if newest else F.lit(0)
            order = F.coalesce(loaded, F.lit(0)) * 2  # one number: load time, then new before old
            both = new.withColumn("_order", order + 1).unionByName(old.withColumn("_order", order))
            merged = latest_per_key(both, KEYS[table], ["_order"]).drop("_order")
            if self.exists(table):
                with self._facts_follow(table, days):
                    (
                        self._by_day(merged, table)
                        .write.mode("overwrite")
                        .option("partitionOverwriteMode", "dynamic")
                        .partitionBy(DAY)
                        .parquet(self.path(table))
                    )
            else:
                self.replace(merged, table)
        files, path = self._hadoop(staged)
        files.delete(path, True)
        return rows

    def changes(self, table: str) -> tuple[DataFrame, list[str]]:
        """(series_id, event_date) noted since they were last settled, and the folders they are in."""
        files, path = self._hadoop(f"{self.root}/_changes/{table}")
        found = files.listStatus(path) if files.exists(path) else []
        folders = [
            s.getPath().toString() for s in found
            if files.exists(self._hadoop(f"{s.getPath().toString()}/_SUCCESS")[1])
        ]
        if not folders:
            return self.spark.createDataFrame([], CHANGE), []
        return self.spark.read.schema(CHANGE).parquet(*folders), folders

    def exists_folder(self, folder: str) -> bool:
        files, path = self._hadoop(folder)
        return files.exists(path)

    def has(self, folder: str) -> bool:
        """A folder that was written to its end."""
        return self.exists_folder(f"{folder}/_SUCCESS")

    def drop(self, *folders: str) -> None:
        """Delete folders, such as notes that have been acted upon."""
        for folder in folders:
            files, path = self._hadoop(folder)
            files.delete(path, True)

    def _stage(self, df: DataFrame, table: str) -> tuple[str, int]:
        """Rows with their days in a folder that is read whole: no file for each day, which the table gets anyway."""
        folder, seen = f"{self.root}/_staging/{table}-{uuid.uuid4().hex}", Observation()
        rows = conform(df, table).withColumn(DAY, F.to_date("timestamp_hour"))
        rows.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(folder)
        return folder, seen.get["rows"]

    def _write(
        self, df: DataFrame, table: str, folder: str, days: list[date] | None = None
    ) -> int:
        """Append to a folder; rows, and for ``days`` their days, are noted while they are written."""
        seen, cells = Observation(), [F.count(F.lit(1)).alias("rows")]
        if days is not None:
            cells.append(F.collect_set(F.coalesce(F.col(DAY).cast("string"), F.lit(""))).alias("days"))
        self._by_day(df, table).observe(seen, *cells).write.mode("append").partitionBy(DAY).parquet(folder)
        if days is not None:
            days.extend(date.fromisoformat(d) if d else None for d in seen.get["days"])
        return seen.get["rows"]

    def facts(self, table: str) -> DataFrame:
        """Facts of every day and run. Days of a write whose facts did not follow are read anew."""
        stored, due = self._stored_facts(table), self._facts_due(table)
        if not self.keeps_facts or stored is None or None in due:
            return day_facts(self.read(table), table).select(*_names(FACTS))
        if not due:
            return stored
        fresh = day_facts(self.read(table).where(F.col(DAY).isin(list(due))), table)
        return stored.where(~_on(list(due))).unionByName(fresh)

    def _facts_folder(self, table: str) -> str:
        return f"{self.root}/_facts/{table}"

    def _stored_facts(self, table: str) -> DataFrame | None:
        found = [f for f in self._folders(self._facts_folder(table)) if "/v" in f]
        return self.spark.read.schema(FACTS).parquet(sorted(found)[-1]) if found else None

    def _facts_due(self, table: str) -> set[date | None]:
        """Days whose facts have to follow a write; None stands for all."""
        folders = self._folders(f"{self.root}/_facts_due/{table}")
        if not folders:
            return set()
        return {r[0] for r in self.spark.read.schema("event_date date").parquet(*folders).collect()}

    def _folders(self, parent: str) -> list[str]:
        """Folders below ``parent`` that were written to their end."""
        files, path = self._hadoop(parent)
        if not files.exists(path):
            return []
        found = [s.getPath().toString() for s in files.listStatus(path) if s.isDirectory()]
        return [f for f in found if self.has(f)]

    @contextmanager
    def _facts_follow(self, table: str, days: list[date] | None) -> Iterator[list[date]]:
        """Around a write: its days are noted as due before it, and their facts stored after it.

        The list that is handed out takes the days of a write that does not know them beforehand;
        without any, all facts are made anew.
        """
        written: list[date] = []
        if not self.keeps_facts:
            yield written
            return
        note = f"{self.root}/_facts_due/{table}/{uuid.uuid4().hex}"
        rows = [(d,) for d in days] if days is not None else [(None,)]
        self.spark.createDataFrame(rows, "event_date date").coalesce(1).write.parquet(note)
        yield written
        touched, stored = days if days is not None else written, self._stored_facts(table)
        if touched and stored is not None:
            fresh = day_facts(self.read(table).where(_on(touched)), table)
            every = stored.where(~_on(touched)).unionByName(fresh)
        else:
            every = day_facts(self.read(table), table)
        folder = self._facts_folder(table)
        old = sorted(f for f in self._folders(folder) if "/v" in f)
        number = int(old[-1].rsplit("/v", 1)[1]) + 1 if old else 1
        every.select(*_names(FACTS)).coalesce(1).write.mode("overwrite").parquet(f"{folder}/v{number:012d}")
        self.drop(note, *old[:-1])


def _names(schema: str) -> list[str]:
    return [part.split()[0] for part in schema.split(",")]


def _on(days: list[date | None]) -> Column:
    """Rows of the given days; None is the day of rows without an hour."""
    known = F.col(DAY).isin([d for d in days if d is not None])
    return F.coalesce(known, F.lit(None in days))


def _with_day(table: str) -> T.StructType:
    return T.StructType(SCHEMAS[table].fields + [T.StructField(DAY, T.DateType(), True)])
