"""Versioned embedding tables on a plain file system, and one-off saves.

A version is a small pointer file that names a Parquet folder for each bucket of ids and the micro-batch that made it, so
a batch that is run again after a failure changes nothing and a batch of few ids reads and writes their buckets only.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sampleloom.operators.ordering import positions
from sampleloom.operators.tables import DEFAULT_EXPIRE_DAYS, evict
from sampleloom.session import settled

ROWS_PER_BUCKET = 5_000_000


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small control file, or None."""
    if not exists(spark, path):
        return None
    return "\n".join(r[0] for r in spark.read.text(path).limit(100).collect())


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Replace a small control file: written aside, then renamed into place."""
    fs, p = _fs(spark, path)
    aside = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path + ".new")
    out = fs.create(aside, True)
    out.write(bytearray(text.encode()))
    out.close()
    if fs.exists(p):
        fs.delete(p, False)
    fs.rename(aside, p)


class Conflict(RuntimeError):
    """Two writers made the same version; the later one has to start again from the current state."""


class TableStore:
    """Versions of one table under a folder that every executor can reach, in ``buckets`` by the hash of ``key``.

    Version n is the file ``pointer/n``: for each bucket the folder that holds it, and the micro-batch that made it. A
    commit of some buckets writes those alone and carries the others over. The pointer file is renamed into place
    only where none is, so of two writers one fails with :class:`Conflict`. Folders that the last ``keep`` versions do not name are removed.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 8, key: str = "fid", keep: int = 3) -> None:
        self.spark, self.path, self.buckets, self.key, self.keep = spark, path.rstrip("/"), buckets, key, keep

    def _versions(self) -> list[int]:
        fs, p = _fs(self.spark, f"{self.path}/pointer")
        if not fs.exists(p):
            return []
        return sorted(int(f.getPath().getName()) for f in fs.listStatus(p) if f.getPath().getName().isdigit())

    def _state(self, version: int) -> dict:
        return json.loads(read_text(self.spark, f"{self.path}/pointer/{version}"))

    def _latest(self) -> dict:
        v = self._versions()
        return self._state(v[-1]) if v else {"version": -1, "batch": -1, "schema": None, "buckets": {}}

    def pointer(self) -> dict:
        s = self._latest()
        return {"version": s["version"], "batch": s["batch"]}

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def touched(self, ids: DataFrame) -> list[int]:
        """Buckets of a column ``key``: at most ``buckets`` numbers."""
        return sorted(r[0] for r in ids.select(self.bucket().alias("b")).distinct().collect())

    def _read(self, state: dict, wanted: list[int] | None) -> DataFrame:
        if state["version"] < 0:
            raise FileNotFoundError(f"no table version under {self.path}")
        folders = [d for b, d in sorted(state["buckets"].items(), key=lambda x: int(x[0])) if wanted is None or int(b) in wanted]
        reader = self.spark.read.schema(state["schema"])
        return reader.parquet(*[f"{self.path}/{d}" for d in folders]) if folders else self.spark.createDataFrame([], state["schema"])

    def current(self) -> DataFrame:
        return self._read(self._latest(), None)

    def part(self, buckets: list[int]) -> DataFrame:
        """The rows of some buckets; no other file is read."""
        return self._read(self._latest(), list(buckets))

    def commit(self, df: DataFrame, batch: int | None = None, buckets: list[int] | None = None) -> bool:
        """Write ``df`` as the next version, or as the content of ``buckets`` in it. False if ``batch`` was committed before.

        Rows of other buckets than the named ones are refused: the write fails."""
        old = self._latest()
        if batch is not None and batch <= old["batch"]:
            return False
        v = old["version"] + 1
        folder = f"data/v{v}-{uuid.uuid4().hex[:8]}"
        place = self.bucket()
        if buckets is not None:
            named = F.array(*[F.lit(int(b)) for b in buckets]).cast("array<int>")
            place = F.when(F.array_contains(named, place), place).otherwise(F.raise_error(F.lit("a row of a bucket that is not committed")).cast("int"))
        rows = df.withColumn("_bucket", place)
        rows.repartition(self.buckets, "_bucket").write.partitionBy("_bucket").parquet(f"{self.path}/{folder}")
        fs, p = _fs(self.spark, f"{self.path}/{folder}")
        made = {f.getPath().getName().split("=")[1]: f"{folder}/{f.getPath().getName()}" for f in fs.listStatus(p) if f.isDirectory()
                and f.getPath().getName().startswith("_bucket=")}
        kept = {} if buckets is None else {b: d for b, d in old["buckets"].items() if int(b) not in buckets}
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
        self._publish({"version": v, "batch": old["batch"] if batch is None else batch, "schema": schema, "buckets": kept | made})
        return True

    def _publish(self, state: dict) -> None:
        jvm, target = self.spark.sparkContext._jvm, f"{self.path}/pointer/{state['version']}"
        aside = f"{self.path}/pointer/new-{uuid.uuid4().hex}"
        write_text(self.spark, aside, json.dumps(state))
        path = jvm.org.apache.hadoop.fs.Path
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(path(target).toUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        keep_old = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            files.rename(path(aside), path(target), keep_old)  # fails where the version is there already
        except Exception as e:
            raise Conflict(f"version {state['version']} of {self.path} is made by another writer") from e
        self._clean()

    def _clean(self) -> None:
        """Remove what the last ``keep`` versions do not name."""
        versions = self._versions()
        live = {d.split("/_bucket=")[0] for v in versions[-self.keep:] for d in self._state(v)["buckets"].values()}
        old = versions[:-self.keep]
        for v in old:
            for d in {x.split("/_bucket=")[0] for x in self._state(v)["buckets"].values()} - live:
                fs, p = _fs(self.spark, f"{self.path}/{d}")
                fs.delete(p, True)
            fs, p = _fs(self.spark, f"{self.path}/pointer/{v}")
            fs.delete(p, False)


def bucket_count(rows: int, rows_per_bucket: int = ROWS_PER_BUCKET) -> int:
    return max(1, -(-rows // rows_per_bucket))


def table_save(tables: DataFrame, path: str, expire_days: dict[int, int] | None = None,
               default_days: int = DEFAULT_EXPIRE_DAYS, buckets: int | None = None,
               mode: str = "errorifexists") -> DataFrame:
    """Write the live entries by table and id bucket; returns ``(table, entries)`` counts. A finished
    save carries Spark's ``_SUCCESS`` marker."""
    spark = tables.sparkSession
    live = evict(tables, expire_days or {}, default_days)
    n = buckets or bucket_count(live.count())
    out = live.withColumn("bucket", F.pmod("fid", F.lit(n).cast("bigint")).cast("int"))
    out.repartition("table", "bucket").write.mode(mode).partitionBy("table", "bucket").parquet(path)
    return spark.read.parquet(path).groupBy("table").agg(F.count(F.lit(1)).alias("entries"))


def table_restore(spark: SparkSession, path: str) -> DataFrame:
    """Read a save back. An absent timestamp counts as 0; an unfinished or missing save fails."""
    if not exists(spark, f"{path}/_SUCCESS"):
        raise FileNotFoundError(f"no finished table save at {path}")
    df = spark.read.parquet(path).drop("bucket")
    return df.withColumn("last_update_ts", F.coalesce("last_update_ts", F.lit(0).cast("bigint")))


def save_bucketed(table: DataFrame, name: str, path: str, buckets: int, mode: str = "errorifexists") -> DataFrame:
    """Store one table hashed and sorted by id under a catalog name. Lookups and updates joined on
    ``fid`` then move only their own side: the stored vectors are never shuffled or sorted again."""
    (table.repartition(buckets, "fid").write.mode(mode).option("path", path)
     .bucketBy(buckets, "fid").sortBy("fid").saveAsTable(name))
    return table.sparkSession.table(name)


def save_pages(tables: DataFrame, path: str, shards: int, rows_per_file: int = ROWS_PER_BUCKET, mode: str = "errorifexists") -> None:
    """Store tables for reading shard by shard in id order: files of ``rows_per_file`` entries in a row, and a list of the
    first and last id of each file."""
    shard = F.pmod("fid", F.lit(shards).cast("bigint")).cast("int")
    rows = positions(tables.withColumn("shard", shard), ["table", "shard"], [F.col("fid")], "_pos")
    rows = settled(rows.withColumn("part", F.floor((F.col("_pos") - 1) / rows_per_file).cast("int")).drop("_pos"))
    spread = rows.repartition("table", "shard", "part").sortWithinPartitions("table", "shard", "part", "fid")
    spread.write.mode(mode).partitionBy("table", "shard", "part").parquet(f"{path}/entries")
    ends = rows.groupBy("table", "shard", "part").agg(F.min("fid").alias("low"), F.max("fid").alias("high"), F.count(F.lit(1)).alias("n"))
    ends.repartition("shard").sortWithinPartitions("table", "part").write.mode(mode).partitionBy("shard").parquet(f"{path}/ends")


def stored_page(spark: SparkSession, path: str, table: str, shard: int, limit: int, after: int | None = None) -> DataFrame:
    """The next ``limit`` entries of a stored shard behind the id ``after``, in id order. Only the files that hold them are read."""
    ends = spark.read.parquet(f"{path}/ends").filter((F.col("shard") == shard) & (F.col("table") == table))
    ends = ends if after is None else ends.filter(F.col("high") > after)
    # the first files with enough entries; the first of them may lie before the cursor in part
    some, parts = 0, []
    for r in ends.orderBy("low").limit(2 + limit // max(1, ends.agg(F.min("n")).first()[0] or 1)).toLocalIterator():
        parts.append(r["part"])
        some += r["n"] if after is None or r["low"] > after else 0
        if some >= limit:
            break
    rows = spark.read.parquet(f"{path}/entries").filter((F.col("table") == table) & (F.col("shard") == shard) & F.col("part").isin(parts))
    rows = rows if after is None else rows.filter(F.col("fid") > after)
    return rows.drop("shard", "part").orderBy("fid").limit(limit)


def stored_pages(spark: SparkSession, path: str, table: str, shard: int, limit: int) -> DataFrame:
    """All pages of a stored shard at once: its entries with ``page_no``, cut as a walk with :func:`stored_page` cuts them, in one
    job for any number of pages. Entries are numbered inside their file; the list of files says how many lie before it."""
    mine = (F.col("shard") == shard) & (F.col("table") == table)
    ends = spark.read.parquet(f"{path}/ends").filter(mine)
    earlier = Window.orderBy("low").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    before = ends.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_before"))
    rows = spark.read.parquet(f"{path}/entries").filter(mine).join(before, "part")
    at = F.col("_before") + F.row_number().over(Window.partitionBy("part").orderBy("fid")) - 1
    return rows.withColumn("page_no", F.floor(at / limit).cast("bigint")).drop("shard", "part", "_before")


def max_update_ts(tables: DataFrame) -> DataFrame:
    return tables.agg(F.max("last_update_ts").alias("max_update_ts"))


def pool_save(pool: DataFrame, path: str, shards: int, mode: str = "errorifexists") -> None:
    """Item pool by ``channel mod shards``."""
    (pool.withColumn("shard", F.pmod("channel", F.lit(shards)).cast("int"))
     .write.mode(mode).partitionBy("shard").parquet(path))


def pool_restore(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Read saved pools; counts of items found in several saves add up, the earliest place wins."""
    df = reduce(lambda a, b: a.unionByName(b), [spark.read.parquet(p).drop("shard") for p in paths])
    return df.groupBy("channel", "item").agg(F.min("seq").alias("seq"), F.sum("origin_cnt").alias("origin_cnt"))
