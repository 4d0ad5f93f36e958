"""Reading, guarding, routing and watching streams."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from sampleloom.operators.samples import route_flow
from sampleloom.session import checkpoint_dir
from sampleloom.sources.table_store import exists, read_text, write_text

BatchFn = Callable[[DataFrame, int], None]


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder beside the checkpoints, reachable by all executors."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def file_stream(spark: SparkSession, path: str, schema, glob: str | None = None,
                files_per_trigger: int | None = None) -> DataFrame:
    """Parquet files as they appear; the position is kept in the query's checkpoint."""
    r = spark.readStream.schema(schema)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if files_per_trigger:
        r = r.option("maxFilesPerTrigger", files_per_trigger)
    return r.parquet(path)


def run_available(df: DataFrame, checkpoint: str, each_batch: BatchFn | None = None, path: str | None = None,
                  mode: str = "append") -> StreamingQuery:
    """Process what is there and stop, into a batch function or a Parquet folder."""
    w = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    q = w.foreachBatch(each_batch).start() if each_batch else w.format("parquet").start(path)
    q.awaitTermination()
    return q


def stop_when_idle(query: StreamingQuery, stream_timeout: float, poll: float = 1.0) -> int:
    """Stop a query after ``stream_timeout / poll`` looks in a row without new input. A running trigger, input that
    waits and a finished batch with rows reset the count, so no batch is cut off. A negative timeout never stops.
    Returns the number of looks."""
    limit = max(1, round(stream_timeout / poll)) if stream_timeout >= 0 else None
    idle, looks, last = 0, 0, None
    while query.isActive:
        time.sleep(poll)
        looks += 1
        status, p = query.status, query.lastProgress
        moved = p is not None and p["numInputRows"] > 0 and p["batchId"] != last
        last = p["batchId"] if p is not None else last
        # a trigger that looks for input in vain is active as well, but that is no batch
        busy = status["isTriggerActive"] and not status["message"].startswith("Getting offsets")
        idle = 0 if moved or busy or status["isDataAvailable"] else idle + 1
        if limit is not None and idle >= limit:
            query.stop()
    return looks


class MinRows:
    """Batch function that waits for at least ``rows`` rows: a short micro-batch is put aside under ``path`` and handed
    over together with the next one that makes the number full. ``flush`` hands over what is left at the end.

    ``done`` records the last batch handed over; a batch that is run again gives the same call again."""

    def __init__(self, spark: SparkSession, rows: int, fn: BatchFn, path: str) -> None:
        self.spark, self.rows, self.fn, self.path = spark, rows, fn, path.rstrip("/")

    def _waiting(self, before: int) -> list[str]:
        done = int(read_text(self.spark, f"{self.path}/done") or -1)
        return [f"{self.path}/batch={i}" for i in range(done + 1, before) if exists(self.spark, f"{self.path}/batch={i}/_SUCCESS")]

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        held = self._waiting(batch_id)
        full = batch.unionByName(self.spark.read.schema(batch.schema).parquet(*held)) if held else batch
        if full.limit(self.rows).count() >= self.rows:
            self._hand_over(full, batch_id)
        else:
            batch.write.mode("overwrite").parquet(f"{self.path}/batch={batch_id}")

    def _hand_over(self, rows: DataFrame, batch_id: int) -> None:
        self.fn(rows, batch_id)
        write_text(self.spark, f"{self.path}/done", str(batch_id))

    def flush(self, last_batch: int) -> bool:
        """Hands over short batches up to ``last_batch`` that still wait; False if there are none."""
        held = self._waiting(last_batch + 1)
        if held:
            self._hand_over(self.spark.read.parquet(*held), last_batch)
        return bool(held)


def flow_writer(flows: Sequence[str], path: str, key: str = "data_source_key") -> BatchFn:
    """Batch function that routes rows to one folder per flow in a single pass. The batch number is
    part of the path and overwritten, so a repeated batch leaves no duplicates."""
    def write(batch: DataFrame, batch_id: int) -> None:
        route_flow(batch, flows, key).write.mode("overwrite").partitionBy("flow").parquet(f"{path}/batch={batch_id}")
    return write


def observed(df: DataFrame, name: str, metrics: dict[str, Column]) -> DataFrame:
    """Attach counters that show up in the query's progress, at no extra pass."""
    return df.observe(name, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in metrics.items()])


def counting(metrics: dict[str, Column], path: str, fn: BatchFn | None = None) -> BatchFn:
    """Batch function that calls ``fn`` and writes the counters of each micro-batch to ``path`` (``batch, millis, rows`` and ``metrics``). A
    repeated batch replaces its own counters, so sums over ``path`` are right after any number of batches.

    The counters are observed on the rows on their way through ``fn``, whose first action must read the whole batch; there
    is no pass of their own. Without ``fn`` the rows go nowhere."""
    def count(batch: DataFrame, batch_id: int) -> None:
        began = time.time()
        sums = [F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in metrics.items()]]
        seen = Observation()
        rows = batch.observe(seen, *sums)
        if fn is not None:
            fn(rows, batch_id)
        else:
            rows.write.format("noop").mode("overwrite").save()
        got = seen.get
        spark, schema = batch.sparkSession, batch.agg(*sums).schema  # the types only
        made = spark.createDataFrame([tuple(got[f.name] for f in schema)], schema)
        made.select(F.lit(batch_id).alias("batch_no"), F.lit(int(1000 * (time.time() - began))).alias("millis"), "*").coalesce(1).write.mode(
            "overwrite").parquet(f"{path}/batch={batch_id}")
    return count


class CounterLog(StreamingQueryListener):
    """Writes the :func:`observed` counters ``name`` of every finished batch of the session's queries to ``path``, as the
    query reports them: for sinks that take no batch function. One line for each batch of a query, replaced if it is run again."""

    def __init__(self, spark: SparkSession, name: str, path: str) -> None:
        self.spark, self.name, self.path = spark, name, path.rstrip("/")

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        row = (p.observedMetrics or {}).get(self.name)
        if row is not None and p.numInputRows:
            line = {"query": str(p.id), "batch_no": p.batchId, "millis": p.durationMs.get("triggerExecution", 0), **row.asDict()}
            write_text(self.spark, f"{self.path}/{p.id}-{p.batchId}.json", json.dumps(line))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def counters(self) -> DataFrame:
        return self.spark.read.json(f"{self.path}/*.json")


def throughput(query: StreamingQuery) -> list[dict]:
    """Number, rows, rows per second, duration and observed metrics of the batches that Spark still remembers (the last
    hundred by default): a look at a running query. Use :func:`counting` for totals."""
    out = []
    for p in query.recentProgress:
        out.append({"batch": p["batchId"], "rows": p["numInputRows"],
                    "rows_per_second": p["processedRowsPerSecond"],
                    "millis": p["durationMs"].get("triggerExecution", 0),
                    "observed": {k: v.asDict() if hasattr(v, "asDict") else dict(v)
                                 for k, v in (p["observedMetrics"] or {}).items()}})
    return out
