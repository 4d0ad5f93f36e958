"""Table updates, delta sync and expiry driven by micro-batches."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sampleloom.operators import tables as E
from sampleloom.operators.admission import first_in_key, touched_keys
from sampleloom.operators.joins import lookup_join
from sampleloom.sources.table_store import TableStore, exists
from sampleloom.streaming.flows import BatchFn

GradientFn = Callable[[DataFrame, DataFrame], DataFrame]


@dataclass(frozen=True)
class Step:
    """Part of a micro-batch's work on a table: the new rows of what it was given, and the ids it touches (None: all of
    the table). ``due`` says in which batches it takes part."""

    apply: Callable[[DataFrame, DataFrame, int], DataFrame]
    ids: Callable[[DataFrame], DataFrame] | None = None
    due: Callable[[int], bool] = lambda batch_id: True


def gradient_step(gradients: GradientFn, segments: Sequence[E.Segment], lr: float | None = None,
                  ids: Callable[[DataFrame], DataFrame] | None = None) -> Step:
    """Gradients of the batch, applied; the batch number is the update time. ``gradients(batch, table)`` returns
    ``(table, fid, grad)``, ``ids(batch)`` the ids that it can touch."""
    return Step(lambda table, batch, batch_id: E.apply_gradients(table, gradients(batch, table), segments, batch_id, lr), ids)


def expiry_step(batches: int, expire_days: dict[int, int], default_days: int = E.DEFAULT_EXPIRE_DAYS) -> Step:
    """Entries expire on every ``batches``-th micro-batch; the whole table is looked at."""
    return Step(lambda table, batch, batch_id: E.evict(table, expire_days, default_days), None, lambda i: (i + 1) % batches == 0)


def table_writer(store: TableStore, *steps: Step) -> BatchFn:
    """All steps of a micro-batch one after the other, and one commit. Only the buckets of the touched ids are read and
    written, unless a step that is due needs the whole table."""
    def write(batch: DataFrame, batch_id: int) -> None:
        due = [s for s in steps if s.due(batch_id)]
        if not due or batch_id <= store.pointer()["batch"]:
            return
        buckets = None
        if all(s.ids is not None for s in due):
            buckets = sorted({b for s in due for b in store.touched(s.ids(batch))})
        table = store.current() if buckets is None else store.part(buckets)
        for s in due:
            table = s.apply(table, batch, batch_id)
        store.commit(table, batch_id, buckets)
    return write


def update_writer(store: TableStore, gradients: GradientFn, segments: Sequence[E.Segment],
                  lr: float | None = None, ids: Callable[[DataFrame], DataFrame] | None = None) -> BatchFn:
    """Look up, compute gradients, apply them, commit the next version."""
    return table_writer(store, gradient_step(gradients, segments, lr, ids))


def evict_every(store: TableStore, batches: int, expire_days: dict[int, int],
                default_days: int = E.DEFAULT_EXPIRE_DAYS) -> BatchFn:
    """Expire entries on every ``batches``-th micro-batch, as the only change of the table. Beside updates, give both steps
    to one :func:`table_writer`."""
    return table_writer(store, expiry_step(batches, expire_days, default_days))


def delta_writer(store: TableStore, ids: Callable[[DataFrame], DataFrame], path: str, chunk: int = 10000,
                 buckets: int = 64) -> BatchFn:
    """Write the current vectors of the ids a batch touched, as bounded messages, from their buckets of the store. Start
    the query with ``trigger(processingTime="10 seconds")`` for the usual sync rhythm."""
    def push(batch: DataFrame, batch_id: int) -> None:
        touched = touched_keys(ids(batch), E.KEY)
        rows = store.part(store.touched(touched))
        E.delta_since(rows, touched, chunk, buckets).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
    return push


def delta_consumer(serving: TableStore) -> BatchFn:
    """Apply pushed deltas to a serving copy, once per batch, in the buckets of the pushed ids."""
    def pull(batch: DataFrame, batch_id: int) -> None:
        if batch_id > serving.pointer()["batch"]:
            latest = batch.groupBy(*E.KEY).agg(F.max_by("num", "batch").alias("num"))
            hit = serving.touched(latest)
            serving.commit(E.delta_apply(serving.part(hit), latest), batch_id, hit)
    return pull


def chain(*steps: BatchFn) -> BatchFn:
    """Run several batch functions over one micro-batch, read once."""
    def run(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for s in steps:
                s(batch, batch_id)
        finally:
            batch.unpersist()
    return run


def admission_writer(counts: TableStore, threshold: Column, most: int, path: str) -> BatchFn:
    """Admission with counts in a table instead of the state store: the way for streams in which one
    id holds a large share of the rows. Only the deciding occurrence of each id is looked for, and
    counts are summed before the shuffle."""
    def step(batch: DataFrame, batch_id: int) -> None:
        if batch_id <= counts.pointer()["batch"] and exists(batch.sparkSession, f"{path}/batch={batch_id}/_SUCCESS"):
            return
        at = F.struct("req_time", "sample_id")
        hit = counts.touched(batch)
        before = counts.part(hit).select("fid", F.col("cnt").alias("_b"))
        rows = batch.select("fid", "req_time", "sample_id", threshold.alias("_t"))
        firsts = first_in_key(rows, ["fid"], max(most, 1), [F.col("req_time"), F.col("sample_id")], "_n")
        need = F.col("_t") - F.coalesce("_b", F.lit(0))
        cuts = (lookup_join(firsts, before, "fid").filter(F.col("_n") == F.greatest(need, F.lit(1)))
                .select("fid", need.alias("_need"), at.alias("_cut")))
        j = lookup_join(rows, cuts, "fid")
        ok = F.when(F.col("_t") == 0, True).when(F.col("_need") <= 0, True).otherwise(
            F.coalesce(at > F.col("_cut"), F.lit(False)))
        j.select("fid", "sample_id", ok.alias("admitted")).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        new = batch.groupBy("fid").agg(F.count(F.lit(1)).alias("_c"))
        total = before.join(new, "fid", "full_outer").select(
            "fid", (F.coalesce("_b", F.lit(0)) + F.coalesce("_c", F.lit(0))).alias("cnt"))
        counts.commit(total, batch_id, hit)
    return step
