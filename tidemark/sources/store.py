"""The warehouse's tables: staged batches, append-only histories and published snapshots.

Plain Spark tables are neither transactional nor keyed. So data is always written aside, checked, and then made
visible by one small note in the warehouse's folder: the next load of a history, or the next version of a table. A
note is created only if there is none of that number, so of two writers at the same time one fails and can try again.
A lost executor or a failed check leaves readers with what they had.

The notes are the truth. ``create`` registers what they name in the session's catalog, whichever that is, so another
process opens the same folder and goes on.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, DataFrameWriter, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.checks import key_report
from tidemark.operators.parts import PART, KeyRanges
from tidemark.schemas import AUDIT_SCHEMA, AUDIT_TABLE, MART_SCHEMA, MART_TABLE, TS, UPLOAD_ORDER, Entity
from tidemark.session import shared_dir


#: Spark's limit.
MOST_BUCKETS = 100_000
PARTITIONS_AT_ONCE = 200
#: Of all files: a fifth smaller than Spark's default.
COMPRESSION = "zstd"
OBJECT_STORES = ("s3", "s3a", "gs", "abfs", "abfss", "wasb", "wasbs", "oss")
#: Beyond so many files of a table in parts, small ones cost more to write, list and open than their rows do ...
MANY_FILES = 10_000
#: ... so that a file then holds more rows than asked for, this many at most.
GOOD_FILE_ROWS = 1_000_000
#: Times that a load looks for the next free number.
TRIES = 100


class KeyCheckFailed(Exception):
    """A key column holds NULL, or a key occurs twice; nothing was made visible."""


def _columns(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)


def _sound(name: str, key: Sequence[str], reports: Sequence[Row]) -> Sequence[Row]:
    twice, null = (sum(r[c] for r in reports) for c in ("n_duplicate_keys", "n_null_keys"))
    if twice or null:
        raise KeyCheckFailed(f"{name}: {twice} duplicate and {null} NULL keys in {list(key)}")
    return reports


class Store:
    """``buckets`` is noted when a bucketed table is first published, by default from the shuffle partitions of that
    session, and kept from then on. ``keep`` versions of a published table before the current one stay for readers
    that have begun. A table in parts has about ``buckets`` times ``rows_per_file`` rows in each when it is begun, and more
    if it would have over ``MANY_FILES`` files otherwise."""

    def __init__(
        self, spark: SparkSession, database: str, folder: str | None = None, buckets: int | None = None, keep: int = 1,
        rows_per_file: int = 1_000_000,
    ):
        self.spark = spark
        self.database = database
        self.folder = f"{(folder or shared_dir(spark)).rstrip('/')}/{database}"
        self.buckets = buckets or min(MOST_BUCKETS, int(spark.conf.get("spark.sql.shuffle.partitions")))
        self.keep = keep
        self.rows_per_file = rows_per_file
        self.watchers: list[Callable[[], None]] = []
        if not 0 < self.buckets <= MOST_BUCKETS:
            raise ValueError(f"between 1 and {MOST_BUCKETS} buckets, not {buckets}")

    def create(self) -> Store:
        """Opens the folder: registers what its notes name, and creates what does not exist yet."""
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database} LOCATION '{self.folder}'")
        for entity in UPLOAD_ORDER:
            name = f"{entity.history_table}_loads"
            by_load = f"({_columns(entity.history_schema)}, load_no bigint) USING parquet PARTITIONED BY (load_no)"
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {self._name(name)} {by_load} LOCATION '{self.folder}/{name}'")
            for number, note in self._notes(name).items():
                self._add_load(name, number, note["folder"])
            visible = ", ".join(f"`{c}`" for c in entity.history_schema.names)
            self.spark.sql(
                f"CREATE VIEW IF NOT EXISTS {self._name(entity.history_table)} AS SELECT {visible} "
                f"FROM {self._name(name)}"
            )
            self._open_target(entity.target, entity.target_schema)
        self._open_target(MART_TABLE, MART_SCHEMA)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self._name(AUDIT_TABLE)} ({_columns(AUDIT_SCHEMA)}) USING parquet "
            f"LOCATION '{self.folder}/{AUDIT_TABLE}'"
        )
        return self

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(self._name(table))

    def table(self, name: str) -> DataFrame:
        return self.spark.table(self._name(name))

    def stage(self, name: str, df: DataFrame) -> int:
        """Replaces a staging table; returns its rows, counted from the written files' metadata.

        The new rows are written aside, and become the table's in one step: a failure leaves what was staged before.
        """
        version, _ = self._current(name)
        snapshot = f"{name}__{uuid.uuid4().hex}"
        try:
            self._writer(df).option("path", f"{self.folder}/{snapshot}").saveAsTable(self._name(snapshot))
            written = self.table(snapshot)
            note = {"snapshot": snapshot, "columns": _columns(written.schema), "visible": written.columns,
                    "includes": 0, "bucket_by": None, "buckets": None}
            self._note(name, version + 1, note)
        except Exception:
            self._drop(snapshot)
            raise
        self._show(name, note)
        self._forget(name, version + 1 - self.keep)
        return written.count()

    def append_history(self, entity: Entity, batch: DataFrame) -> int:
        """Adds a batch to a history as one numbered load, once its keys are checked; returns the rows added.

        Of two loads at the same time, the second finds its number taken, checks its keys against the first and takes
        the next number; neither is lost.
        """
        name = f"{entity.history_table}_loads"
        path = f"{self.folder}/{name}/{uuid.uuid4().hex}"
        self._writer(batch.select(*entity.history_schema.names)).parquet(path)
        written = self.spark.read.schema(entity.history_schema).parquet(path)
        try:
            rows = self._check(entity.history_table, written, entity.history_key)
            number = self._add_to_history(entity, written, name, path) if rows else 0
        except Exception:
            self._delete(path)  # no one will read this batch
            raise
        if rows:
            self._add_load(name, number, path)
        else:
            self._delete(path)
        return rows

    def _add_to_history(self, entity: Entity, written: DataFrame, name: str, path: str) -> int:
        for last_try in [False] * (TRIES - 1) + [True]:
            notes = self._notes(name)
            for number, note in notes.items():  # loads of other writers, which this session has not seen yet
                self._add_load(name, number, note["folder"])
            self._check_new(entity, written)
            number = max(notes, default=0) + 1
            try:
                self._note(name, number, {"folder": path})
                return number
            except FileExistsError:
                if last_try:
                    raise
        raise AssertionError("unreachable")

    def last_load(self, entity: Entity) -> int:
        return max(self._notes(f"{entity.history_table}_loads"), default=0)

    def loads(self, entity: Entity, up_to: int, after: int = 0) -> DataFrame:
        """The history's rows that came with some loads; others are not read."""
        rows = self.table(f"{entity.history_table}_loads")
        return rows.where((F.col("load_no") > after) & (F.col("load_no") <= up_to)).drop("load_no")

    def included(self, name: str) -> int:
        """The last load a published table includes; 0 if it is empty or was made in another way."""
        return self._current(name)[1].get("includes", 0)

    def sources(self, name: str) -> dict[str, int]:
        """For a table derived from others, the last load of each that it was derived from; empty if not noted."""
        return self._current(name)[1].get("sources") or {}

    def ranges(self, name: str) -> KeyRanges | None:
        """How a published table is cut into parts; None if it is not."""
        ranges = self._current(name)[1].get("ranges")
        return ranges and KeyRanges(**ranges)

    def shared_ranges(self, key: str, keys: DataFrame) -> KeyRanges:
        """The ranges of a key that all tables in parts share, so that a part of one meets the same part of another.

        They are made once, from the first ``keys`` there are, and kept from then on.
        """
        name = f"ranges_of_{key}"
        _, note = self._current(name)
        if not note:
            low, high, rows = keys.agg(F.min(key), F.max(key), F.count(key)).first()
            per_file = max(self.rows_per_file, min(GOOD_FILE_ROWS, math.ceil(rows / MANY_FILES)))
            made = KeyRanges.over(key, low, high, rows, self.buckets * per_file)
            if not rows:
                return made
            try:
                self._note(name, 1, {"key": key, "base": made.base, "size": made.size})
            except FileExistsError:  # tables are refreshed side by side, and one of them was faster
                pass
            _, note = self._current(name)
        return KeyRanges(**note)

    def parts_of(self, name: str, only: Sequence[int]) -> DataFrame:
        """The rows of some parts of a table; files of others are not read."""
        note = self._current(name)[1]
        rows = self.table(note["snapshot"])
        return rows.where(F.col(PART).isin(list(only)) if only else F.lit(False)).select(*note["visible"])

    def publish(
        self,
        name: str,
        df: DataFrame,
        key: Sequence[str],
        bucket_by: str | None = None,
        observation: Observation | None = None,
        observed: F.Column | None = None,
        includes: int = 0,
        ranges: KeyRanges | None = None,
        only: Sequence[int] | None = None,
        sort_by: Sequence[str] = (),
        sources: dict[str, int] | None = None,
    ) -> int:
        """Replaces a table's content, once the new content's keys are checked; returns its rows.

        ``bucket_by`` lays the table out by that column, so that later joins on it need no shuffle; the number of
        buckets is the table's own. ``observed`` is counted into ``observation`` while writing, and its columns beyond
        the table's are not stored. ``includes`` is noted as the last load the content includes, ``sources`` as the
        last loads of the tables it was derived from. If another writer has replaced the content meanwhile, this one
        fails.

        ``ranges`` cuts the table into parts by its key, a partition each. With ``only``, ``df`` replaces those parts
        alone: the files of all others stay where they are and belong to the new version as well. A key's part follows
        from the key, so that keys need checking in the written parts only. ``sort_by`` orders rows in files.
        """
        columns = self.table(name).columns
        version, replaced = self._current(name)
        if only is not None and (ranges is None or replaced.get("ranges") != vars(ranges)):
            raise ValueError(f"{name} is not cut into these parts")
        snapshot = f"{name}__{uuid.uuid4().hex}"
        if observation is not None:
            df = df.observe(observation, F.count(observed).alias("n"))
        buckets = (replaced.get("buckets") or self.buckets) if bucket_by else None
        df = df.select(*columns, *([ranges.part()] if ranges else []))
        if ranges and not bucket_by:  # files of a good size for each part, large parts spread over several tasks
            df = df.hint("rebalance", F.col(PART))
        if sort_by:
            df = df.sortWithinPartitions(*([PART] if ranges else []), *sort_by)
        writer = self._writer(df).option("path", f"{self.folder}/{snapshot}")
        if ranges:
            writer = writer.partitionBy(PART)
        if bucket_by:
            writer = writer.bucketBy(buckets, bucket_by).sortBy(bucket_by)
        try:
            writer.saveAsTable(self._name(snapshot))
            written = self.table(snapshot)
            note = {"snapshot": snapshot, "columns": _columns(written.schema), "visible": columns,
                    "includes": includes, "bucket_by": bucket_by, "buckets": buckets}
            if sources:
                note["sources"] = sources
            if ranges:
                parts = self._check_parts(name, written, key)
                if only is not None and not parts.keys() <= set(only):
                    raise ValueError(f"{name}: rows outside the parts to be replaced")
                stay = {} if only is None else {k: p for k, p in replaced["parts"].items() if int(k) not in set(only)}
                new = {str(k): [f"{self.folder}/{snapshot}/{PART}={k}", n] for k, n in parts.items()}
                note |= {"ranges": vars(ranges), "parts": stay | new}
                rows = sum(n for _, n in note["parts"].values())
            else:
                rows = self._check(name, written, key)
            self._note(name, version + 1, note)
        except Exception:
            self._drop(snapshot)
            raise
        self._show(name, note)
        self._forget(name, version + 1 - self.keep)
        for watch in self.watchers:
            watch()
        return rows

    def _forget(self, name: str, before: int) -> None:
        """Drops versions before that one, and the files that no later version shares."""
        notes = self._notes(name)
        needed = {f for v, note in notes.items() if v >= before for f in self._folders(note)}
        for old, other in notes.items():
            if old >= before:
                continue
            self.spark.sql(f"DROP TABLE IF EXISTS {self._name(other['snapshot'])}")
            unneeded = set(self._folders(other)) - needed
            roots = {f"{self.folder}/{other['snapshot']}", *(f.rpartition("/")[0] for f in unneeded if f"/{PART}=" in f)}
            for folder in unneeded | {r for r in roots if not any(f.startswith(f"{r}/") for f in needed)}:
                self._delete(folder)
            self._delete(f"{self.folder}/_notes/{name}/{old:012d}.json")

    def _folders(self, note: dict) -> list[str]:
        if "parts" in note:
            return [folder for folder, _ in note["parts"].values()]
        return [f"{self.folder}/{note['snapshot']}"]

    @contextmanager
    def kept_aside(self, df: DataFrame) -> Iterator[DataFrame]:
        """The rows as written to a folder of their own while they are needed, so that they are computed once."""
        folder = f"{self.folder}/_aside_{uuid.uuid4().hex}"
        try:
            self._writer(df).parquet(folder)
            yield self.spark.read.schema(df.schema).parquet(folder)
        finally:
            self._delete(folder)

    def append_rows(self, name: str, rows: Sequence[tuple], schema: T.StructType) -> None:
        """Appends a few rows made on the driver, as one file."""
        if rows:
            self.spark.createDataFrame(rows, schema).coalesce(1).write.insertInto(self._name(name))

    @staticmethod
    def _writer(df: DataFrame) -> DataFrameWriter:
        return df.write.option("compression", COMPRESSION)

    def _name(self, table: str) -> str:
        return f"{self.database}.{table}"

    def _open_target(self, name: str, schema: T.StructType) -> None:
        version, note = self._current(name)
        if not version:
            note = {"snapshot": f"{name}__{uuid.uuid4().hex}", "columns": _columns(schema), "visible": schema.names,
                    "includes": 0, "bucket_by": None, "buckets": None}
            self._note(name, 1, note)
        self._show(name, note)

    def _show(self, name: str, note: dict) -> None:
        laid_out = (
            f"CLUSTERED BY ({note['bucket_by']}) SORTED BY ({note['bucket_by']}) INTO {note['buckets']} BUCKETS "
            if note["bucket_by"] else "")
        cut = f"PARTITIONED BY ({PART}) " if note.get("ranges") else ""
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self._name(note['snapshot'])} ({note['columns']}) USING parquet {cut}{laid_out}"
            f"LOCATION '{self.folder}/{note['snapshot']}'")
        parts = [f"PARTITION ({PART} = {k}) LOCATION '{folder}'" for k, (folder, _) in note.get("parts", {}).items()]
        for k in range(0, len(parts), PARTITIONS_AT_ONCE):
            self.spark.sql(
                f"ALTER TABLE {self._name(note['snapshot'])} ADD IF NOT EXISTS "
                + " ".join(parts[k : k + PARTITIONS_AT_ONCE]))
        visible = ", ".join(f"`{c}`" for c in note["visible"])
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {self._name(name)} AS SELECT {visible} FROM {self._name(note['snapshot'])}")

    def _add_load(self, name: str, number: int, folder: str) -> None:
        self.spark.sql(
            f"ALTER TABLE {self._name(name)} ADD IF NOT EXISTS PARTITION (load_no = {number}) LOCATION '{folder}'")

    def _current(self, name: str) -> tuple[int, dict]:
        notes = self._notes(name)
        return max(notes.items(), key=lambda n: n[0], default=(0, {}))

    def _path(self, path: str):
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(path)
        return path, path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _notes(self, name: str) -> dict[int, dict]:
        """By number; a note is a small file of its own."""
        folder, files = self._path(f"{self.folder}/_notes/{name}")
        if not files.exists(folder):
            return {}
        out = {}
        for found in files.listStatus(folder):
            if found.getPath().getName().endswith(".json"):
                stream = files.open(found.getPath())
                raw = bytes(stream.readAllBytes())
                stream.close()
                out[int(found.getPath().getName().removesuffix(".json"))] = json.loads(raw)
        return out

    def _note(self, name: str, number: int, note: dict) -> None:
        """Adds a note, whole or not at all, and fails if the number is taken.

        It is written aside and then given its name in one step that never replaces: a hard link on a local disk, a
        rename elsewhere, which HDFS refuses if the name is taken. Object stores have no such rename, but their
        uploads appear as a whole, and ``create`` without overwriting asks for a conditional one.
        """
        path, files = self._path(f"{self.folder}/_notes/{name}/{number:012d}.json")
        taken = FileExistsError(f"{self.database}.{name}: another writer was faster")
        text = json.dumps(note).encode()
        scheme = files.getUri().getScheme()
        if scheme in OBJECT_STORES:
            if files.exists(path):
                raise taken
            self._write(files, path, text, taken)
            return
        aside, _ = self._path(f"{self.folder}/_notes/{name}/{uuid.uuid4().hex}.new")
        self._write(files, aside, text, taken)
        if scheme == "file":
            jvm = self.spark.sparkContext._jvm
            here, there = (jvm.java.io.File(p.toUri().getPath()).toPath() for p in (aside, path))
            try:
                jvm.java.nio.file.Files.createLink(there, here)
            except Py4JJavaError as error:
                if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
                    raise taken from None
                raise
            finally:
                files.delete(aside, False)
        elif files.exists(path) or not files.rename(aside, path):
            files.delete(aside, False)
            raise taken

    @staticmethod
    def _write(files, path, text: bytes, taken: FileExistsError) -> None:
        try:
            stream = files.create(path, False)
            stream.write(text)
            stream.close()
        except Py4JJavaError as error:
            if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
                raise taken from None
            raise

    def _drop(self, snapshot: str) -> None:
        """Of a table that no note names."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self._name(snapshot)}")
        self._delete(f"{self.folder}/{snapshot}")

    def _delete(self, path: str) -> None:
        path, files = self._path(path)
        files.delete(path, True)

    def _check(self, name: str, written: DataFrame, key: Sequence[str]) -> int:
        return _sound(name, key, key_report(written, key).collect())[0]["n_rows"]

    def _check_parts(self, name: str, written: DataFrame, key: Sequence[str]) -> dict[int, int]:
        """Rows per part; there is a bounded number of parts."""
        return {r[PART]: r["n_rows"] for r in _sound(name, key, key_report(written, key, by=[PART]).collect())}

    def _check_new(self, entity: Entity, written: DataFrame) -> None:
        """No key of the batch may be in the history. Only rows with the batch's stamps can be, so only those are
        read; where the stamp is no part of the key, capture has already removed known keys."""
        if TS not in entity.history_key:
            return
        low, high = written.agg(F.min(TS), F.max(TS)).first()
        same_time = self.table(entity.history_table).where(F.col(TS).between(F.lit(low), F.lit(high)))
        if same_time.isEmpty():  # as usual; the batch's keys need no shuffle then
            return
        if not same_time.join(written, list(entity.history_key), "left_semi").isEmpty():
            raise KeyCheckFailed(f"{entity.history_table}: keys {list(entity.history_key)} were loaded before")
