"""Parquet tables: versioned overwrite and upsert, append-only batches, partitions."""

from __future__ import annotations

import hashlib
import json
import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigiltx.sources.shared import hadoop_path, lent, materialize, shuffles_released, write_compact


# Spark reads this part of a path as a column; the name leaves ``version`` to the user.
VERSION_FOLDER = "vigiltx_version"
# A version of so many folders is written together by the next upsert.
MOST_FOLDERS = 64


class RepeatedKeyError(ValueError):
    """An upsert source holds the same key more than once."""


class ConcurrentWriteError(RuntimeError):
    """Another writer changed the table meanwhile; read it again and repeat."""


class VersionedTable:
    """A table whose every write is a new directory; numbered pointer files name the live one.

    Readers never see a half-written version, a failed write leaves the live one in
    place, and no directory is overwritten while it is read. ``mark`` stores the last
    batch a version includes and ``batches`` the state of each, switched together with
    the data.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def exists(self) -> bool:
        return "mark" in self._live()

    def mark(self) -> str | None:
        return self._live().get("mark")

    def batches(self) -> dict[str, str]:
        """The state, by id, of every batch the table includes."""
        return self._live().get("batches") or {}

    def read(self) -> DataFrame:
        return self._read(self._live())

    def as_view(self, name: str) -> None:
        """Make the table's present content known to SQL under ``name``."""
        self.read().createOrReplaceTempView(name)

    def overwrite(self, df: DataFrame, mark: str | None = None) -> None:
        """Replace rows and schema."""
        base = self._live()
        self._switch(base, {"data": self._write(df)}, mark)

    def upsert(
        self, source: DataFrame, key: str, mark: str | None = None,
        batches: dict[str, str] | None = None, replaced: DataFrame | None = None,
        newest_by: str | None = None, gone: Column | None = None, beaten: Column | None = None,
    ) -> None:
        """Update rows whose key matches, insert the others, keep unmatched target rows.

        Rows whose key is in ``replaced`` go, whether the source has the key or not, and so do
        rows of the table that ``gone`` is true of. Columns new to either side are filled with
        NULL. The source is written first: it feeds the key check and the anti-join, and is
        part of the new version as it lies there, beside the rows that are kept. Folders of
        the table that no row goes from are shared with the last version; the others are found
        by reading little more than the key, and only those that hold one of the keys are
        shuffled. A caller who knows that rows ``beaten`` is not true of share no key with the
        source says so, which spares those the comparison. With ``newest_by`` a row of the
        table that is newer by that column than the source's stays.
        """
        base = self._live()
        written = self._write(source)
        source = self.spark.read.parquet(written)
        reject_repeated_keys(source, key)
        if "mark" not in base:
            return self._switch(base, {"data": written}, mark, batches)
        target = self._read(base)
        with _not_older(source, target, key, newest_by) as batch:
            keys = _keys(batch, key, replaced)
            merged = _without(target, gone).join(keys, key, "left_anti").unionByName(batch, allowMissingColumns=True)
            if not _same_types(target, batch):
                return self._switch(base, {"data": self._write(merged)}, mark, batches)
            if batch is not source:
                written = self._write(batch)
                keys = _keys(self.spark.read.parquet(written), key, replaced)
        shared, kept = self._kept(base, target, key, keys, gone, beaten)
        data = [*shared, *([self._write(kept)] if kept is not None else []), written]
        self._switch(base, {"data": data, "schema": merged.schema.jsonValue()}, mark, batches)

    def _kept(
        self, base: dict, target: DataFrame, key: str, keys: DataFrame, gone: Column | None, beaten: Column | None
    ) -> tuple[list[str], DataFrame | None]:
        """The folders that stay as they are, and what stays of the others."""
        holding = _where(_without(target, gone), beaten).select(key, _folder().alias("_folder"))
        with shuffles_released(self.spark):
            met = cut = _values(holding.join(keys, key, "left_semi"), "_folder")
            if gone is not None:
                cut = met | _values(target.filter(gone).select(_folder().alias("_folder")), "_folder")
        folders = [base["data"]] if isinstance(base["data"], str) else base["data"]
        shared = [f for f in folders if f.rsplit("/", 1)[1] not in cut] if len(folders) < MOST_FOLDERS else []
        by_key = [f for f in folders if f.rsplit("/", 1)[1] in met]
        others = [f for f in folders if f not in shared and f not in by_key]
        read = self.spark.read.schema(target.schema).parquet
        parts = [_without(read(*others), gone)] if others else []
        if by_key:
            rows = _without(read(*by_key), gone)
            parts.append(_where(rows, beaten).join(keys, key, "left_anti"))
            if beaten is not None:
                parts.append(_without(rows, beaten))
        return shared, reduce(DataFrame.unionByName, parts) if parts else None

    def _read(self, version: dict) -> DataFrame:
        if "mark" not in version:
            raise FileNotFoundError(f"no table at {self.path}")
        if "schema" not in version:
            return self.spark.read.parquet(version["data"])
        return self.spark.read.schema(T.StructType.fromJson(version["schema"])).parquet(*version["data"])

    def _write(self, df: DataFrame) -> str:
        target = f"{self.path}/version={uuid.uuid4().hex}"
        write_compact(df, target)
        return target

    def _pointers(self) -> list[int]:
        folder, fs = hadoop_path(self.spark, f"{self.path}/_versions")
        if not fs.exists(folder):
            return []
        names = [status.getPath().getName() for status in fs.listStatus(folder)]
        return sorted(int(name) for name in names if name.isdigit())

    def _live(self) -> dict:
        """The newest pointer and its ``number``; the number alone when there is no table."""
        numbers = self._pointers()
        newest = {"number": max(numbers, default=0)}
        for number in reversed(numbers):
            file, fs = hadoop_path(self.spark, f"{self.path}/_versions/{number:010d}")
            stream = fs.open(file)
            try:
                text = bytes(stream.readAllBytes())
            finally:
                stream.close()
            if text:  # none is written empty; one that is says nothing
                return json.loads(text) | newest
        return newest

    def _switch(
        self, base: dict, version: dict, mark: str | None, batches: dict[str, str] | None = None
    ) -> None:
        """Commit as the version right after ``base``, or not at all.

        The pointer is written under a name of its own and then takes its number, which
        only one writer can get: by a hard link on a local disk, elsewhere by a rename
        that does not replace, as HDFS has it. A store without such a rename needs one
        writer at a time.
        """
        state = base.get("batches") if batches is None else batches
        pointer = json.dumps({**version, "mark": mark or base.get("mark"), "batches": state})
        folder = f"{self.path}/_versions"
        draft, fs = hadoop_path(self.spark, f"{folder}/draft-{uuid.uuid4().hex}")
        final, _ = hadoop_path(self.spark, f"{folder}/{base['number'] + 1:010d}")
        out = fs.create(draft, False)
        try:
            out.write(bytearray(pointer, "utf-8"))
        finally:
            out.close()
        try:
            if fs.getUri().getScheme() == "file":
                os.link(draft.toUri().getPath(), final.toUri().getPath())
            elif fs.exists(final) or not fs.rename(draft, final):
                raise ConcurrentWriteError(self.path)
        except FileExistsError as taken:
            raise ConcurrentWriteError(self.path) from taken
        finally:
            fs.delete(draft, False)


class PartitionedTable(VersionedTable):
    """A versioned table laid out by one column; an upsert rewrites touched partitions only.

    The pointer names the directory of every partition, so a new version shares the
    untouched ones with the last. Suits large tables and batches that fall on few dates.
    """

    def __init__(self, spark: SparkSession, path: str, column: str):
        super().__init__(spark, path)
        self.column = column

    def overwrite(self, df: DataFrame, mark: str | None = None) -> None:
        base = self._live()
        self._switch(base, self._write_parts(df), mark)

    def upsert(
        self, source: DataFrame, key: str, mark: str | None = None,
        batches: dict[str, str] | None = None, replaced: DataFrame | None = None,
        newest_by: str | None = None, gone: Column | None = None, beaten: Column | None = None,
    ) -> None:
        """As ``VersionedTable.upsert``. Touched are the partitions the source writes to
        and those that hold one of its keys now or a row that is ``gone``; those with a key
        are found by reading nothing but the key column."""
        base = self._live()
        batch = materialize(source, "batch")  # feeds several reads, computed once
        reject_repeated_keys(batch, key)
        if "mark" not in base:
            return self._switch(base, self._write_parts(batch), mark, batches)
        target = self._read(base)
        with _not_older(batch, target, key, newest_by) as batch:
            keys = _keys(batch, key, replaced)
            touched = self._values(batch) | self._values(target.join(keys, key, "left_semi"))
            if gone is not None:
                touched |= self._values(target.filter(gone))
            in_touched = F.col(self.column).isin([v for v in touched if v is not None]) | (
                F.col(self.column).isNull() & F.lit(None in touched)
            )
            old = target.filter(in_touched)
            kept = _without(old, gone).join(keys, key, "left_anti")
            version = self._write_parts(kept.unionByName(batch, allowMissingColumns=True))
        replaced = {unquote(name) for name in _values(old.select(_folder().alias("_folder")), "_folder")}
        untouched = {f: v for f, v in base["parts"].items() if f not in replaced}
        self._switch(base, {**version, "parts": untouched | version["parts"]}, mark, batches)

    def _values(self, df: DataFrame) -> set:
        # At most one value per partition of the table or the batch.
        return _values(df, self.column)

    def _read(self, version: dict) -> DataFrame:
        if "mark" not in version:
            raise FileNotFoundError(f"no table at {self.path}")
        schema = T.StructType.fromJson(version["schema"])
        folders = [f"{self.path}/{v}/{f}" for f, v in sorted(version["parts"].items())]
        if not folders:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema).option("basePath", self.path)
        return reader.parquet(*folders).drop(VERSION_FOLDER)

    def _write_parts(self, df: DataFrame) -> dict:
        name = f"{VERSION_FOLDER}={uuid.uuid4().hex}"
        write_partitioned(df, f"{self.path}/{name}", [self.column])
        folder, fs = hadoop_path(self.spark, f"{self.path}/{name}")
        names = [status.getPath().getName() for status in fs.listStatus(folder)]
        parts = {f: name for f in names if f.startswith(f"{self.column}=")}
        return {"parts": parts, "schema": df.schema.jsonValue()}


def _values(df: DataFrame, column: str) -> set:
    return {row[0] for row in df.select(column).distinct().collect()}


def _folder() -> Column:
    """The name of the directory a row's file lies in."""
    return F.element_at(F.split("_metadata.file_path", "/"), -2)


def _where(df: DataFrame, true: Column | None) -> DataFrame:
    return df if true is None else df.filter(true)


def _without(df: DataFrame, gone: Column | None) -> DataFrame:
    return df if gone is None else df.filter(~F.coalesce(gone, F.lit(False)))


@contextmanager
def _not_older(
    batch: DataFrame, target: DataFrame, key: str, newest_by: str | None
) -> Iterator[DataFrame]:
    """The rows of ``batch`` but those whose key the table has with a newer row."""
    if newest_by is None or newest_by not in target.columns:
        yield batch
        return
    own = batch.select(F.col(key).alias("_key"), F.col(newest_by).alias("_own"))
    newer = (
        target.select(F.col(key).alias("_key"), F.col(newest_by).alias("_there"))
        .join(own, "_key")
        .filter(F.col("_there") > F.col("_own"))
        .select("_key")
    )
    with lent(newer, "newer") as newer:
        yield batch.join(newer, batch[key] == newer["_key"], "left_anti")


def _same_types(one: DataFrame, two: DataFrame) -> bool:
    """Whether the columns that both have are spelled and typed alike, so that one schema reads both."""
    names, kinds = {c.lower(): c for c in one.columns}, dict(one.dtypes)
    return all(names.get(c.lower(), c) == c and kinds.get(c, kind) == kind for c, kind in two.dtypes)


def _keys(batch: DataFrame, key: str, replaced: DataFrame | None) -> DataFrame:
    keys = batch.select(key)
    return keys if replaced is None else keys.union(replaced.select(key))


def reject_repeated_keys(df: DataFrame, key: str) -> None:
    repeated = (
        df.filter(F.col(key).isNotNull()).groupBy(key).count().filter("count > 1").limit(1)
    )
    with shuffles_released(df.sparkSession):
        unique = repeated.isEmpty()
    if not unique:
        raise RepeatedKeyError(f"the source repeats values of {key}")


def write_partitioned(df: DataFrame, path: str, columns: list[str]) -> None:
    """Lay a table out by ``columns``. Rebalancing splits a partition that is too big
    for one task and joins small ones, so a hot day or channel is not one file."""
    (
        df.hint("rebalance", *columns)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy(*columns)
        .parquet(path)
    )


def append_batch(df: DataFrame, path: str, batch_id: str, source_system: str) -> None:
    """Add one batch to an append-only table, stamped with where it came from.

    The batch owns its partition directory: running it again replaces that directory
    and nothing else, also when the batch has no rows any more.
    """
    stamped = with_lineage(df, batch_id, source_system).drop("batch_id")
    write_compact(stamped, batch_folder(path, batch_id), "overwrite")


def batch_folder(path: str, batch_id: str) -> str:
    return f"{path}/batch_id={_escaped(batch_id)}"


def _escaped(value: str) -> str:
    """A partition value as Spark spells it in a directory name."""
    special = '"#%\'*/:=?\\{[]^\x7f'
    return "".join(f"%{ord(c):02X}" if c in special or ord(c) < 32 else c for c in value)


def with_lineage(df: DataFrame, batch_id: str, source_system: str) -> DataFrame:
    return df.withColumn("batch_id", F.lit(batch_id)).withColumn(
        "source_system", F.lit(source_system)
    )


def batch_states(spark: SparkSession, path: str) -> dict[str, str]:
    """The id of every batch and a fingerprint of its files, which any rerun changes."""
    folder, fs = hadoop_path(spark, path)
    states = {}
    for entry in fs.listStatus(folder) if fs.exists(folder) else []:
        name = entry.getPath().getName()
        if entry.isDirectory() and name.startswith("batch_id="):
            files = sorted(
                (f.getPath().getName(), f.getLen(), f.getModificationTime())
                for f in fs.listStatus(entry.getPath())
            )
            text = json.dumps([f for f in files if f[0][0] not in "_."])
            states[unquote(name.split("=", 1)[1])] = hashlib.md5(text.encode()).hexdigest()
    return states


def read_batches(
    spark: SparkSession, path: str, after: str | None = None, schema=None
) -> DataFrame:
    """Batches later than ``after``, by ids that sort as text; older ones are pruned by
    directory.

    Without a schema, columns that appeared over time are merged.
    """
    if schema is None:
        schema = spark.read.option("mergeSchema", "true").parquet(path).schema
    # Ids stay the text they are: as numbers 009 and 10 would change and sort otherwise.
    fields = [f for f in schema.fields if f.name != "batch_id"]
    whole = T.StructType([*fields, T.StructField("batch_id", T.StringType())])
    batches = spark.read.schema(whole).parquet(path)
    return batches if after is None else batches.filter(F.col("batch_id") > F.lit(after))
