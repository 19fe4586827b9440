"""Structured Streaming for the CDC feed (an extension the reference recommends).

* ``stream_cdc_dedup``: drop replayed change events (same ``seq``) inside a
  watermark, so state stays bounded.
* ``stream_daily_movements``: tumbling one-day windows of movements with a
  watermark; late rows past it are dropped by Spark.
* ``daily_movements_batch``: ``foreachBatch`` body for the same windows that
  drops nothing: a batch adds one row for each window it touches, however late,
  and ``read_daily_movements`` adds them up.
* ``balance_upsert_batch``: ``foreachBatch`` body that extends the running
  balances with each micro-batch. Every batch writes to a directory named by
  its batch id (a replay overwrites the same directory) and records the newest
  balances of the users it touched; after ``COMPACT_AFTER`` batches the state is
  written whole once. Users with late movements are rebuilt from the stored
  batches; ``read_balances`` reads the history that results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from walletyield.config import CDC, MONEY, WALLET_HISTORY
from walletyield.operators.ledger import extend_history, ledger_state, wallet_history


#: Batches whose rows are added to the last whole table before it is written anew.
COMPACT_AFTER = 32


def read_cdc_stream(spark: SparkSession, path: str, glob: str | None = None,
                    max_files_per_trigger: int | None = None) -> DataFrame:
    """File stream of parquet CDC rows with the declared schema."""
    r = spark.readStream.schema(CDC)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(path)


def _event_time(stream: DataFrame) -> DataFrame:
    # watermarks need a session-zone timestamp; the session zone is UTC
    return stream.withColumn("_et", F.col("ts").cast("timestamp"))


def stream_cdc_dedup(stream: DataFrame, watermark: str = "1 day", key: str = "seq") -> DataFrame:
    return (_event_time(stream).withWatermark("_et", watermark)
            .dropDuplicatesWithinWatermark([key]).drop("_et"))


def stream_daily_movements(stream: DataFrame, watermark: str = "1 day") -> DataFrame:
    return (_event_time(stream).withWatermark("_et", watermark)
            .groupBy(F.window("_et", "1 day").alias("w"))
            .agg(F.count(F.lit(1)).alias("movements"),
                 F.sum("amount_change").alias("net_change"))
            .select(F.col("w.start").cast("timestamp_ntz").alias("window_start"),
                    "movements", F.col("net_change").cast(MONEY).alias("net_change")))


def _versions(path: str, spark: SparkSession | None = None, below: int | None = None, kind: str = "v") -> list[int]:
    """Batches whose ``v=<batch>`` directory holds a complete write (_SUCCESS), oldest first.

    ``below`` leaves out that batch and later ones: a replayed batch must start
    from what was there before it, not from what it wrote itself.

    Listed through the Hadoop FileSystem API, so it works on the shared
    cluster storage as well as locally.
    """
    spark = spark or SparkSession.getActiveSession()
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    done = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if name.startswith(f"{kind}=") and fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
            done.append(int(name[len(kind) + 1 :]))
    return sorted(v for v in done if below is None or v < below)


def _latest_version(path: str, spark: SparkSession | None = None, below: int | None = None) -> str | None:
    """The newest of the complete versions below ``path``."""
    done = _versions(path, spark, below)
    return f"{path.rstrip('/')}/v={done[-1]}" if done else None


def _log(spark: SparkSession, path: str, below: int | None = None) -> tuple[int | None, list[int]]:
    """The newest whole table below ``path`` (``full=<batch>``) and the batches after it."""
    full = _versions(path, spark, below, "full")
    last = full[-1] if full else None
    return last, [v for v in _versions(path, spark, below) if last is None or v > last]


def _read_log(spark: SparkSession, path: str, schema: str, below: int | None = None) -> DataFrame:
    """The rows of the whole table and of the batches after it, with ``_batch``."""
    last, batches = _log(spark, path, below)
    folders = ([f"{path}/full={last}"] if last is not None else []) + [f"{path}/v={n}" for n in batches]
    if not folders:
        return spark.createDataFrame([], f"{schema}, _batch long")
    return spark.read.schema(schema).parquet(*folders).withColumn("_batch", _batch_of())


def _compact(spark: SparkSession, path: str, whole: DataFrame, batch_id: int) -> None:
    """Write the table whole once ``COMPACT_AFTER`` batches stand behind the last one, and
    delete what it replaces but for the one whole table before, from which a replay starts."""
    last, batches = _log(spark, path, batch_id + 1)
    if len(batches) < COMPACT_AFTER:
        return
    whole.write.mode("overwrite").parquet(f"{path}/full={batch_id}")
    jvm = spark._jvm
    fs = jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    older = _versions(path, spark, last, "full") if last is not None else []
    for name in [f"full={v}" for v in older] + ([f"v={v}" for v in _versions(path, spark, last + 1)] if last is not None else []):
        fs.delete(jvm.org.apache.hadoop.fs.Path(f"{path}/{name}"), True)


STATE = "seq long, user_id long, ts timestamp_ntz, balance decimal(18,2)"
WINDOWS = "window_start timestamp_ntz, movements long, net_change decimal(18,2)"


def read_state(spark: SparkSession, state_path: str, below: int | None = None) -> DataFrame:
    """The newest ``(seq, user_id, ts, balance)`` of each user after the complete batches."""
    rows = _read_log(spark, state_path.rstrip("/"), STATE, below)
    return (rows.groupBy("user_id").agg(F.max_by(F.struct("seq", "ts", "balance"), "_batch").alias("_s"))
            .select("_s.seq", "user_id", "_s.ts", "_s.balance"))


def read_balances(spark: SparkSession, state_path: str, out_path: str, late_path: str,
                  below: int | None = None) -> DataFrame:
    """The history of the complete batches (those before ``below``).

    A batch with late movements of a user holds the user's whole history up to
    it, which replaces the rows of the batches before.
    """
    batches = _versions(out_path, spark, below, "batch")
    if not batches:
        return spark.createDataFrame([], WALLET_HISTORY)
    rows = spark.read.schema(WALLET_HISTORY).parquet(*(f"{out_path}/batch={n}" for n in batches))
    rows = rows.withColumn("_batch", _batch_of())
    late = spark.read.schema(CDC).parquet(*(f"{late_path}/batch={n}" for n in batches))
    rebuilt = late.select("user_id", _batch_of().alias("_since")).groupBy("user_id").agg(F.max("_since").alias("_since"))
    return (rows.join(rebuilt, "user_id", "left").where(F.col("_since").isNull() | (F.col("_batch") >= F.col("_since")))
            .select("seq", "user_id", "ts", "amount_change", "balance"))


def _batch_of():
    """The batch id in the path of a row's file."""
    return F.regexp_extract(F.input_file_name(), r"/(?:batch|v|full)=(\d+)/[^/]*$", 1).cast("long")


def balance_upsert_batch(batch: DataFrame, batch_id: int, state_path: str, out_path: str,
                         late_path: str) -> None:
    """Extend the running balances with one micro-batch (foreachBatch body).

    Uses the batch operator :func:`extend_history` against the state before this
    batch. Rows older than a user's stored newest movement
    are recorded in ``late_path``, and their users are rebuilt from the stored
    batches, so the order of arrival doesn't matter; of a late user a movement
    whose ``seq`` is stored already is a replay and isn't counted again. Every
    output is written under the batch id, so a replayed batch overwrites its own
    files; the state of users that the batch doesn't touch is not written.
    """
    spark = batch.sparkSession
    inc = batch.select("seq", "user_id", "ts", "amount_change")
    late_dir = f"{late_path}/batch={batch_id}"
    prior = read_state(spark, state_path, batch_id)
    _, late = extend_history(prior, inc)
    late.write.mode("overwrite").parquet(late_dir)
    late_users = spark.read.schema(CDC).parquet(late_dir).select("user_id").distinct()
    if late_users.isEmpty():
        hist, _ = extend_history(prior, inc)
    else:
        hist, _ = extend_history(prior, inc.join(late_users, "user_id", "left_anti").select(inc.columns))
        stored = (read_balances(spark, state_path, out_path, late_path, batch_id).select(inc.columns)
                  .join(late_users, "user_id", "left_semi"))
        new = inc.join(late_users, "user_id", "left_semi").join(stored.select("user_id", "seq"), ["user_id", "seq"], "left_anti")
        hist = hist.unionByName(wallet_history(stored.unionByName(new.select(inc.columns))))
    hist.write.mode("overwrite").parquet(f"{out_path}/batch={batch_id}")
    touched = spark.read.schema(WALLET_HISTORY).parquet(f"{out_path}/batch={batch_id}")
    ledger_state(touched).write.mode("overwrite").parquet(f"{state_path}/v={batch_id}")
    _compact(spark, state_path, read_state(spark, state_path, batch_id + 1), batch_id)


def daily_movements_batch(batch: DataFrame, batch_id: int, table_path: str) -> None:
    """Add a micro-batch to the daily windows (foreachBatch body): one row for each window
    it touches, whatever its age. A replayed batch overwrites its own rows."""
    spark = batch.sparkSession
    (batch.groupBy(F.date_trunc("day", "ts").cast("timestamp_ntz").alias("window_start"))
     .agg(F.count(F.lit(1)).alias("movements"), F.sum("amount_change").cast(MONEY).alias("net_change"))
     .write.mode("overwrite").parquet(f"{table_path}/v={batch_id}"))
    _compact(spark, table_path, read_daily_movements(spark, table_path, batch_id + 1), batch_id)


def read_daily_movements(spark: SparkSession, table_path: str, below: int | None = None) -> DataFrame:
    """Movements and net change of each day over the complete batches."""
    return (_read_log(spark, table_path.rstrip("/"), WINDOWS, below).groupBy("window_start")
            .agg(F.sum("movements").alias("movements"), F.sum("net_change").cast(MONEY).alias("net_change")))


def write_in_time_slices(df: DataFrame, path: str, slices: int = 4, ts: str = "ts") -> None:
    """Land a feed as ``slices`` successive appends in time order (a file
    stream picks files up by arrival, like a real CDC landing zone)."""
    lo, hi = df.agg(F.min(ts), F.max(ts)).first()
    span = (hi - lo) / slices
    for i in range(slices):
        a = lo + span * i
        cond = F.col(ts) >= F.lit(a) if i else F.lit(True)
        if i < slices - 1:
            cond = cond & (F.col(ts) < F.lit(lo + span * (i + 1)))
        df.where(cond).write.mode("append").parquet(path)


def run_available_now(df: DataFrame, checkpoint: str, sink_path: str | None = None,
                      foreach_batch=None, output_mode: str = "append",
                      state_partitions: int | None = None) -> None:
    """Drive a stream over all available input, then stop (bounded runs).

    ``state_partitions`` sizes the state store of a new query (it is fixed
    in the checkpoint at the first batch); the session value is restored
    once the query has started with its own copy of the settings.
    """
    w = df.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint) \
        .trigger(availableNow=True)
    conf = df.sparkSession.conf
    old = conf.get("spark.sql.shuffle.partitions")
    if state_partitions:
        conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    try:
        if foreach_batch is not None:
            q = w.foreachBatch(foreach_batch).start()
        else:
            q = w.format("parquet").option("path", sink_path).start()
    finally:
        conf.set("spark.sql.shuffle.partitions", old)
    q.awaitTermination()


def window_upsert_batch(batch: DataFrame, batch_id: int, table_path: str) -> None:
    """Publish updated windows: new version = old minus updated keys + updates."""
    prev = _latest_version(table_path, batch.sparkSession, batch_id)
    out = batch
    if prev:
        old = batch.sparkSession.read.parquet(prev)
        out = old.join(batch.select("window_start"), "window_start", "left_anti").unionByName(batch)
    out.write.mode("overwrite").parquet(f"{table_path}/v={batch_id}")


def latest(spark: SparkSession, table_path: str) -> DataFrame:
    v = _latest_version(table_path, spark)
    return spark.read.parquet(v)


__all__ = ["read_cdc_stream", "daily_movements_batch", "read_daily_movements", "read_state", "stream_cdc_dedup", "stream_daily_movements", "balance_upsert_batch", "read_balances",
           "run_available_now", "window_upsert_batch", "latest", "write_in_time_slices"]
