"""Incremental import of feed deliveries from a landing folder (L-1, L-2, N-1…N-4, N-8).

A Structured Streaming query watches the landing folder for zip deliveries
(``binaryFile`` source) and merges the deliveries of a micro-batch in ``foreachBatch``, in
order of arrival; :func:`sweep_folder` imports a folder in
order of file names and :func:`sync_index` follows a feed index.  However many deliveries
there are, they are merged in one go, with the result of merging one after the other:

1. skip those whose (file, owner version) is already in the ledger;
2. expand the archives into table lines, written to a staging folder, and parse
   the tables in the owners' charsets (A-4, A-1, A-3);
3. metadata (owner, first/last operating day, N-1); an expired delivery
   only gets a ledger row, which the purge then tombstones;
4. stamp new version ids (N-3), compress journeys if asked (N-5), write every
   table to ``tables/<table>/version=<v>`` and the merged operating days to
   ``operday/snapshot=<v>``, by the policies of owner and mode (N-4);
5. refresh and purge the ledger (N-8) and commit it as ``ledger/snapshot=<v>`` (the last version);
6. delete what no live version needs any more (K-6).  The snapshots before the
   current ones stay until the next commit, for jobs that still read them.

Everything before step 5 overwrites folders named by the versions, and the
versions come from the last committed ledger, so a job that fails half way is
simply run again.  A snapshot counts once its ``_SUCCESS`` marker exists; the
operating days belong to the newest committed ledger.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import increment as I
from ..operators import profiles
from ..sources import kv1, schemas
from ..sources.archives import expand
from ..sources.charsets import charset_of_owner

BINARY_SCHEMA = "path string, modificationTime timestamp, length long, content binary"
LEDGER_SCHEMA = ("version int, dataownercode string, validfrom date, validthru date, filename string, "
                 "dataownerversion int, unitcode string, purged boolean")
OPERDAY_SCHEMA = ("version int, dataownercode string, organizationalunitcode string, schedulecode string, "
                  "scheduletypecode string, validdate date")


#: Snapshots that stay besides the current one.
KEPT = 1


class Delivery(NamedTuple):
    """One archive to import: its path, the key it is known by, and whether it adds to a baseline."""

    path: str
    key: str
    dataownerversion: int = 1
    delta: bool = True


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _children(spark: SparkSession, path: str) -> list[str]:
    """Names below a folder (names only; no data is read)."""
    p, fs = _fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def _numbered(spark: SparkSession, path: str, key: str) -> list[int]:
    """The complete ``key=<n>`` folders below ``path``, ascending."""
    found = []
    for name in _children(spark, path):
        if name.startswith(key + "=") and "_SUCCESS" in _children(spark, f"{path}/{name}"):
            found.append(int(name.split("=", 1)[1]))
    return sorted(found)


def _remove(spark: SparkSession, path: str) -> None:
    p, fs = _fs(spark, path)
    fs.delete(p, True)


def read_ledger(spark: SparkSession, store: str) -> DataFrame:
    """The newest committed ledger."""
    done = _numbered(spark, f"{store}/ledger", "snapshot")
    if not done:
        return spark.createDataFrame([], LEDGER_SCHEMA)
    return spark.read.schema(LEDGER_SCHEMA).parquet(f"{store}/ledger/snapshot={done[-1]}")


def _operday(spark: SparkSession, store: str) -> DataFrame | None:
    done = _numbered(spark, f"{store}/ledger", "snapshot")
    known = [n for n in _numbered(spark, f"{store}/operday", "snapshot") if done and n <= done[-1]]
    return spark.read.schema(OPERDAY_SCHEMA).parquet(f"{store}/operday/snapshot={known[-1]}") if known else None


def current_operday(spark: SparkSession, store: str) -> DataFrame | None:
    """Operating days of the live versions, as of the newest committed ledger."""
    od = _operday(spark, store)
    return None if od is None else I.cascade_live(od, read_ledger(spark, store).filter(~F.col("purged"))).select(*I.OPERDAY_KEYS)


def _commit_ledger(spark: SparkSession, store: str, ledger: DataFrame, operday: DataFrame | None, as_of, number: int) -> None:
    """Refresh validthru and purge flags (a purged version stays purged) and publish the snapshot."""
    if operday is None:
        fresh = ledger.withColumn("purged", F.lit(True))
    else:
        fresh = I.purge_expired(ledger.withColumnRenamed("purged", "was"), operday, as_of) \
            .withColumn("purged", F.col("purged") | F.col("was"))
    fresh.select(*[c.split()[0] for c in LEDGER_SCHEMA.split(", ")]).write.mode("overwrite") \
        .parquet(f"{store}/ledger/snapshot={number}")


def sweep_dead(spark: SparkSession, store: str) -> list[str]:
    """Delete the table folders of versions that are no longer live and the snapshots
    before the current ones (K-6); returns what went.  Safe to repeat."""
    live = {r["version"] for r in read_ledger(spark, store).filter(~F.col("purged")).select("version").collect()}
    gone = []
    for table in _children(spark, f"{store}/tables"):
        for name in _children(spark, f"{store}/tables/{table}"):
            if name.startswith("version=") and int(name.split("=", 1)[1]) not in live:
                gone.append(f"{store}/tables/{table}/{name}")
    ledgers = _numbered(spark, f"{store}/ledger", "snapshot")
    gone += [f"{store}/ledger/snapshot={n}" for n in ledgers[:-1 - KEPT]]
    days = [n for n in _numbered(spark, f"{store}/operday", "snapshot") if ledgers and n <= ledgers[-1]]
    gone += [f"{store}/operday/snapshot={n}" for n in days[:-1 - KEPT]]
    for path in gone:
        _remove(spark, path)
    return gone


def withdraw(spark: SparkSession, store: str, keys: DataFrame, as_of: _dt.date | None = None) -> bool:
    """Drop the imports whose file is in ``keys`` (one column): their ledger rows, and with
    them their tables and operating days (L-4, K-6).  False when there are none."""
    ledger = read_ledger(spark, store)
    left = ledger.join(keys.select(F.col(keys.columns[0]).alias("filename")).distinct(), "filename", "left_anti")
    if left.count() == ledger.count():
        return False
    number = _numbered(spark, f"{store}/ledger", "snapshot")[-1] + 1
    left.select(*ledger.columns).write.mode("overwrite").parquet(f"{store}/ledger/snapshot={number}")
    sweep_dead(spark, store)
    return True


def _parsed(lines: DataFrame, table: str, dialect: str, charset_of: dict[int, str]) -> DataFrame:
    """A table of several deliveries, each in its own charset, stamped with their versions."""
    out = None
    for charset in sorted(set(charset_of.values())):
        own = lines.filter(F.col("stamp").isin([v for v, c in charset_of.items() if c == charset]))
        part = kv1.parse_lines(own, table, dialect, charset, keep=("stamp",))
        out = part if out is None else out.unionByName(part)
    return out.withColumn("version", F.col("stamp")).drop("stamp")


def merge_deliveries(spark: SparkSession, files: DataFrame, store: str, order: Sequence[Delivery], policy: str | None = None,
                     dialect: str = "standard", charset: str | None = None, as_of: _dt.date | None = None, compress: bool = False) -> list[str]:
    """Merge deliveries (``files``: their binaryFile rows) in the given order; returns the keys
    that had not been imported before.  Without ``policy`` a delivery's owner and ``delta``
    (adds to a baseline, or replaces it) choose it; without ``charset`` the owner does.

    The driver handles names, owners and versions (a manifest), never data."""
    as_of = as_of or _dt.date.today()
    ledger = read_ledger(spark, store)
    known = {(r["filename"], r["dataownerversion"]) for r in ledger.select("filename", "dataownerversion").collect()}
    todo: list[Delivery] = []
    for d in order:
        if (d.key, d.dataownerversion) not in known:
            known.add((d.key, d.dataownerversion))
            todo.append(d)
    if not todo:
        return []
    done = _numbered(spark, f"{store}/ledger", "snapshot")
    first = max(I.next_version(ledger), done[-1] + 1 if done else 1)
    version = {first + i: d for i, d in enumerate(todo)}
    last = first + len(todo) - 1
    stamps = spark.createDataFrame([(d.path, v) for v, d in version.items()], "of string, stamp int")
    staging = f"{store}/staging/version={first}"
    expand(files.join(F.broadcast(stamps), F.col("path") == F.col("of"), "left_semi")).join(F.broadcast(stamps), F.col("archive") == F.col("of")).drop("of") \
        .write.mode("overwrite").partitionBy("table").parquet(staging)
    present = {n.split("=", 1)[1] for n in _children(spark, staging) if n.startswith("table=")}

    def lines(t: str) -> DataFrame:
        return spark.read.schema("archive string, member string, line string, stamp int").parquet(f"{staging}/table={t}")

    # one row per delivery: owner, first and last day; the owner chooses charset and policy
    rows = []
    if "operday" in present:
        days = _parsed(lines("operday"), "operday", dialect, dict.fromkeys(version, charset or "UTF-8"))
        rows = I.feed_metadata(days, by=("version", "dataownercode")).orderBy("version", "dataownercode").collect()
    meta = {r["version"]: r for r in reversed(rows)}
    if lacking := [d.key for v, d in version.items() if v not in meta]:
        raise ValueError(f"delivery {', '.join(lacking)} has no OPERDAY table")
    charset_of = {v: charset or charset_of_owner(m["dataownercode"]) for v, m in meta.items()}
    policies = [(v, policy or I.merge_policy(m["dataownercode"], version[v].delta)) for v, m in meta.items()]
    entries = [(v, m["dataownercode"], m["valid_from"], m["valid_thru"], version[v].key, version[v].dataownerversion) for v, m in sorted(meta.items())]
    new_rows = spark.createDataFrame(entries, "version int, dataownercode string, validfrom date, validthru date, filename string, dataownerversion int") \
        .withColumn("unitcode", I.unit_code(F.col("dataownercode"), F.col("filename"))).withColumn("purged", F.lit(False))
    new_ledger = ledger.unionByName(new_rows.select(*ledger.columns))
    live = {v: c for v, c in charset_of.items() if meta[v]["valid_thru"] is not None and meta[v]["valid_thru"] >= as_of - _dt.timedelta(days=1)}
    base = current_operday(spark, store)
    operday = _operday(spark, store)
    if live:
        tables = {t: _parsed(lines(t), t, dialect, live) for t in schemas.IMPORT_ORDER if t in present}
        if compress and "pujopass" in tables:
            tables |= profiles.compress_journeys(tables["pujopass"])
        for t, df in tables.items():
            if t != "operday":
                df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("version").parquet(f"{store}/tables/{t}")
        days = tables["operday"].select(*I.OPERDAY_KEYS, F.col("version").alias("delivery"))
        if base is not None:
            days = base.select(*I.OPERDAY_KEYS, F.lit(0).alias("delivery")).unionByName(days)
        schedvers = tables["schedvers"].withColumn("delivery", F.col("version")) if "schedvers" in tables else None
        merged = I.merge_many(days, spark.createDataFrame(policies, "delivery int, policy string"), schedvers, new_ledger)
        merged.select(*I.OPERDAY_KEYS).write.mode("overwrite").parquet(f"{store}/operday/snapshot={last}")
        operday = spark.read.schema(OPERDAY_SCHEMA).parquet(f"{store}/operday/snapshot={last}")
    _commit_ledger(spark, store, new_ledger, operday, as_of, last)
    _remove(spark, staging)
    sweep_dead(spark, store)
    return [d.key for d in todo]


def merge_delivery(spark: SparkSession, archive: DataFrame, store: str, name: str, dataownerversion: int = 1, delta: bool = True, **options) -> bool:
    """Merge one delivery (a one-row binaryFile DataFrame) under ``name``.  Returns False when it was imported before."""
    path = archive.select("path").first()[0]
    return bool(merge_deliveries(spark, archive, store, [Delivery(path, name, dataownerversion, delta)], **options))


def _found(spark: SparkSession, folder: str, names: Sequence[str] | None = None) -> tuple[DataFrame | None, dict[str, str]]:
    """The zip files of a folder (binaryFile rows; of ``names`` only), and their paths by name."""
    there = [n for n in _children(spark, folder) if n.lower().endswith(".zip") and (names is None or n in names)]
    if not there:
        return None, {}
    files = spark.read.format("binaryFile").load([f"{folder.rstrip('/')}/{n}" for n in there])
    return files, {r["path"].rsplit("/", 1)[-1]: r["path"] for r in files.select("path").collect()}


def sweep_folder(spark: SparkSession, folder: str, store: str, delta: bool = True, **options) -> list[str]:
    """Import every zip delivery of a folder in order of file names (G-4); the names imported."""
    files, paths = _found(spark, folder)
    return merge_deliveries(spark, files, store, [Delivery(paths[n], n, delta=delta) for n in sorted(paths)], **options)


def sync_index(spark: SparkSession, index: DataFrame, folder: str, store: str, force_baseline_keys: tuple[str, ...] = (),
               **options) -> list[str]:
    """Follow a feed index (N-2, L-1, L-4): withdraw what is no longer published, then import
    what is published and new from ``folder``, in import order; baselines replace, others add.
    The index is one row per delivery.  Returns the keys imported."""
    withdraw(spark, store, I.unpublished_keys(index), options.get("as_of"))
    ledger = read_ledger(spark, store).select(F.col("filename").alias("feedkey"), "dataownerversion")
    plan = I.plan_imports(index, ledger, force_baseline_keys).select("feedkey", "filename", "dataownerversion", "isbaseline").collect()
    files, paths = _found(spark, folder, [r["filename"] for r in plan])
    order = [Delivery(paths[r["filename"]], r["feedkey"], int(r["dataownerversion"]), not r["isbaseline"]) for r in plan]
    return merge_deliveries(spark, files, store, order, **options)


def start_landing_import(spark: SparkSession, landing: str, store: str, checkpoint: str, policy: str | None = None,
                         dialect: str = "standard", charset: str | None = None, as_of: _dt.date | None = None,
                         available_now: bool = True, delta: bool = True, compress: bool = False, files_per_batch: int = 100):
    """Start the streaming import; returns the StreamingQuery."""
    stream = (spark.readStream.format("binaryFile").schema(BINARY_SCHEMA)
              .option("pathGlobFilter", "*.zip").option("maxFilesPerTrigger", files_per_batch).load(landing))

    def handle(batch: DataFrame, epoch_id: int) -> None:
        # file names only: the data never passes the driver
        paths = [r["path"] for r in batch.select("modificationTime", "path").orderBy("modificationTime", "path").collect()]
        merge_deliveries(spark, batch, store, [Delivery(p, p.rsplit("/", 1)[-1], delta=delta) for p in paths], policy=policy,
                         dialect=dialect, charset=charset, as_of=as_of, compress=compress)

    w = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
