"""Incremental loads into silver, streamed or by batch mark."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from vigiltx.operators.clean import clean_stored, clean_transactions, repeated_keys
from vigiltx.schema import BRONZE_TRANSACTIONS, PUBLISHED, SILVER_COLUMNS, adopt_bronze
from vigiltx.sources.shared import lent
from vigiltx.sources.tables import VersionedTable, batch_folder, batch_states, read_batches

# Which file a silver row came from, in the order files were written: time, then path.
LOADED_FROM = "loaded_from"


def stream_silver(
    spark: SparkSession, bronze_path: str, silver: VersionedTable,
    checkpoint: str, files_per_batch: int = 1000,
) -> StreamingQuery:
    """Clean and upsert every bronze file not seen before, then stop.

    Files may have published or own column names, also mixed; one that has neither name of
    the key stops the stream with an error. Other columns of the files found at the start,
    such as lineage, are kept. Of a key's rows the one of the newest file wins, whatever
    files share a micro-batch: silver keeps the file of each row in ``loaded_from``. A
    micro-batch that is run again after a failure upserts the same rows. Use a table
    partitioned by ``tx_date`` where rewriting all of silver per batch is too much.
    """
    schema = _stream_schema(spark, bronze_path)

    def load(batch: DataFrame, _: int) -> None:
        rows = _own_names(batch)
        _reject_files_without_key(spark, rows)
        cleaned = clean_transactions(rows.drop("_file"), newest_by=LOADED_FROM)
        silver.upsert(cleaned, "tx_id", newest_by=LOADED_FROM)

    at = F.date_format("_metadata.file_modification_time", "yyyyMMddHHmmss.SSSSSS")
    path = F.col("_metadata.file_path")
    return (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(bronze_path)
        .select("*", F.concat_ws(" ", at, path).alias(LOADED_FROM), path.alias("_file"))
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _stream_schema(spark: SparkSession, bronze_path: str) -> T.StructType:
    """Every bronze column under both its names, and what else the present files have."""
    own = BRONZE_TRANSACTIONS.fields
    fields = [*own, *(T.StructField(PUBLISHED[f.name], f.dataType) for f in own)]
    known = {f.name for f in fields}
    try:
        found = spark.read.parquet(bronze_path).schema.fields
    except AnalysisException:  # nothing there yet
        found = []
    # Ids of batches stay the text they are.
    extra = [T.StructField(f.name, T.StringType()) if f.name == "batch_id" else f for f in found]
    return T.StructType([*fields, *(f for f in extra if f.name not in known)])


def _own_names(batch: DataFrame) -> DataFrame:
    names = BRONZE_TRANSACTIONS.fieldNames()
    both = {name: F.coalesce(name, PUBLISHED[name]) for name in names}
    return batch.withColumns(both).drop(*(PUBLISHED[name] for name in names))


def _reject_files_without_key(spark: SparkSession, rows: DataFrame) -> None:
    """Looks at the footers of those files alone that gave no key at all."""
    keyless = rows.groupBy("_file").agg(F.count("tx_id").alias("keys")).filter("keys = 0")
    for row in keyless.toLocalIterator():
        adopt_bronze(spark.read.parquet(row["_file"]))


def _batches_schema(
    spark: SparkSession, bronze_path: str, new: list[str], silver: DataFrame | None
) -> T.StructType:
    """Columns of the new batches, those the table has from older ones, and every bronze
    column under both its names. Opens no file of a batch that is not new."""
    fields: dict[str, T.StructField] = {}
    if new:
        folders = [batch_folder(bronze_path, batch) for batch in new]
        fresh = spark.read.option("mergeSchema", "true").parquet(*folders)
        adopt_bronze(fresh)
        fields = {f.name: f for f in fresh.schema.fields}
    for own in BRONZE_TRANSACTIONS.fields:
        names = (own.name, PUBLISHED[own.name])
        kind = next((fields[n].dataType for n in names if n in fields), own.dataType)
        for name in names:
            fields.setdefault(name, T.StructField(name, kind))
    for f in silver.schema.fields if silver is not None else []:
        if f.name not in (*SILVER_COLUMNS, "tx_ts", "batch_id"):
            fields.setdefault(f.name, f)
    return T.StructType(list(fields.values()))


def load_new_batches(spark: SparkSession, bronze_path: str, silver: VersionedTable) -> None:
    """Bring the table to what a load of all bronze batches gives, from those that are new or changed.

    The table keeps the state of each batch. Batches later than all loaded ones are
    upserted. One that comes late goes in where the table has no row of a newer batch. If
    one was run again or is gone, rows of its earlier run leave the table, and their keys
    are taken from what is new and from batches older than it; newer ones have none of
    them. Batches may have published or own column names; new columns are
    looked for in the new batches alone, those of older ones are known from the table.
    """
    found, loaded, exists = batch_states(spark, bronze_path), silver.batches(), silver.exists()
    if exists and not loaded and silver.mark() is not None:
        loaded = dict.fromkeys(found, "")  # a table with a mark alone: any batch may have changed
    new = {b for b, state in found.items() if loaded.get(b) != state}
    again = (new & loaded.keys()) | (loaded.keys() - found.keys())
    if not found or not new | again:
        return
    # What is listed after this is left to the next load.
    schema = _batches_schema(spark, bronze_path, sorted(new), silver.read() if exists else None)
    every = _own_names(read_batches(spark, bronze_path, schema=schema))
    every = every.filter(F.col("batch_id").isin(sorted(found)))
    fresh, mark = every.filter(F.col("batch_id").isin(sorted(new))), max(found)
    if not again and (not loaded or min(new) > max(loaded)):
        with lent(repeated_keys(fresh), "repeated") as repeated:
            rows = clean_stored(fresh, repeated, newest_by="batch_id")
            return silver.upsert(rows, "tx_id", mark=mark, batches=found)
    before = silver.read()
    if not _all_loaded(before, loaded):
        return _take_anew(every, fresh, before, again, silver, mark, found)
    changed, unchanged = F.col("batch_id").isin(sorted(again)), sorted(found.keys() - new)
    rows, older = fresh, [b for b in unchanged if again and b < max(again)]
    if older:
        lost = before.filter(changed).select(F.col("tx_id").alias("_key"), F.col("batch_id").alias("_lost"))
        rows = every.filter(F.col("batch_id").isin(older))
        rows = rows.join(lost, (F.col("tx_id") == F.col("_key")) & (F.col("batch_id") < F.col("_lost")), "left_semi")
        rows = fresh.unionByName(rows)
    rows = clean_transactions(rows, newest_by="batch_id")
    ahead = [b for b in unchanged if new and b > min(new)]
    if ahead:
        there = before.filter(F.col("batch_id").isin(ahead)).select(F.col("tx_id").alias("_key"), F.col("batch_id").alias("_there"))
        rows = rows.join(there, (F.col("tx_id") == F.col("_key")) & (F.col("_there") > F.col("batch_id")), "left_anti")
    # No row of a newer batch is left beside one of the source.
    beaten = F.col("batch_id") < max(new) if new and unchanged and min(unchanged) < max(new) else F.lit(False)
    silver.upsert(rows, "tx_id", mark=mark, batches=found, gone=changed if again else None, beaten=beaten)


def _all_loaded(silver: DataFrame, loaded: dict[str, str]) -> bool:
    """Whether every row tells which of the loaded batches it is from."""
    if "batch_id" not in silver.columns:
        return False
    known = F.col("batch_id").isin(sorted(loaded))
    return silver.filter(~F.coalesce(known, F.lit(False))).isEmpty()


def _take_anew(
    every: DataFrame, fresh: DataFrame, before: DataFrame, again: set[str],
    silver: VersionedTable, mark: str, found: dict[str, str],
) -> None:
    """For a table with rows that no load put there: keys of the new batches, and those
    whose row is from an earlier run, are taken from all batches."""
    keys = fresh.select("tx_id")
    if "batch_id" in before.columns:
        stale = before.filter(F.col("batch_id").isin(sorted(again)))
        keys = keys.union(stale.select("tx_id"))
    with lent(keys.filter("tx_id IS NOT NULL").distinct(), "changed") as keys:
        rows = clean_transactions(every.join(keys, "tx_id", "left_semi"), newest_by="batch_id")
        silver.upsert(rows, "tx_id", mark=mark, batches=found, replaced=keys)
