"""Versioned feed deliveries: ledger, merge and purge (N-1…N-4, N-8, L-1…L-4).

A delivery is merged into the base as DataFrame -> DataFrame functions; the
caller writes the result as a new snapshot (never over the path it reads).
Only ``operday`` rows are replaced; the other tables accumulate per version
and are pruned at export (N-22).

Every rule is a join on business keys: delta-side inputs are reduced to
their distinct keys (schedules, dates) first, so the build side is bounded
by the size of one delivery's calendar, not by its rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.rank import nested_rank
from .calendars import date_range

OPERDAY_KEYS = ["version", "dataownercode", "organizationalunitcode", "schedulecode", "scheduletypecode", "validdate"]
POLICIES = ("range_unit", "range", "same_day", "from_min", "append", "clip_delta", "clip_full")

# ---- fixed values: owners with a merge rule of their own ----
CLIP_OWNERS = ("SYNTUS",)
UNIT_RANGE_OWNERS = ("HTM",)
DELTA_RANGE_OWNERS = ("GVB",)
APPEND_OWNERS = ("QBUZZ",)
# ---- end of fixed values ----


def _date(v) -> Column:
    return v if isinstance(v, Column) else F.lit(str(v)).cast("date")


# ---- N-1 -------------------------------------------------------------------

def feed_metadata(operday: DataFrame, as_of=None, by: tuple[str, ...] = ("dataownercode",)) -> DataFrame:
    """owner, valid_from, valid_thru of a delivery (min/max operating day); ``expired``
    when valid_thru is before ``as_of - 1``."""
    m = operday.groupBy(*by).agg(F.min("validdate").alias("valid_from"), F.max("validdate").alias("valid_thru"))
    if as_of is not None:
        m = m.withColumn("expired", F.col("valid_thru") < F.date_sub(_date(as_of), 1))
    return m


# ---- N-3 -------------------------------------------------------------------

def unit_code(owner: Column, key: Column) -> Column:
    """Import unit code: HTM splits by 'buzz' in the delivery key, others use the owner."""
    return F.when(owner == "HTM", F.when(F.lower(key).contains("buzz"), F.lit("SGHB")).otherwise(F.lit("SGHR"))) \
        .otherwise(owner)


def next_version(ledger: DataFrame, purged: DataFrame | None = None) -> int:
    """Next version id: one more than any id in the ledger or tombstones.

    The ledger is one row per delivery (a manifest); the single-writer merge
    job reads its maximum as a scalar.
    """
    ids = ledger.select("version")
    if purged is not None:
        ids = ids.unionByName(purged.select("version"))
    top = ids.agg(F.max("version")).first()[0]
    return 1 if top is None else int(top) + 1


def stamp_version(tables: dict[str, DataFrame], version: int) -> dict[str, DataFrame]:
    """Set the version id on every staged table (K-5)."""
    return {name: df.withColumn("version", F.lit(version)) for name, df in tables.items()}


def ledger_row(spark, version: int, meta: DataFrame, key: str, dataownerversion: int = 1) -> DataFrame:
    """The ledger row of a new delivery from its metadata (N-3)."""
    return meta.select(
        F.lit(version).alias("version"), "dataownercode", F.col("valid_from").alias("validfrom"),
        F.col("valid_thru").alias("validthru"), F.lit(key).alias("filename"),
        F.lit(dataownerversion).alias("dataownerversion"),
        unit_code(F.col("dataownercode"), F.lit(key)).alias("unitcode"))


# ---- N-4 -------------------------------------------------------------------

def merge_policy(owner: str, delta: bool) -> str:
    """The merge policy of an owner's delivery (§2.1).

    ``delta``: the delivery adds to a baseline; else it replaces it from its
    first day on.  Clipping owners continue with the policy of their mode.
    """
    if owner in UNIT_RANGE_OWNERS:
        return "range_unit"
    if owner in APPEND_OWNERS:
        return "append"
    if not delta:
        return "clip_full" if owner in CLIP_OWNERS else "from_min"
    if owner in DELTA_RANGE_OWNERS:
        return "range"
    return "clip_delta" if owner in CLIP_OWNERS else "same_day"


def clip_to_schedules(delta: DataFrame, schedvers: DataFrame) -> DataFrame:
    """Delta days without those before their schedule's validfrom (matched on the
    full schedule key, owner included: one schedule, one validfrom)."""
    sk = ["version", "dataownercode", "organizationalunitcode", "schedulecode", "scheduletypecode"]
    sv = schedvers.select(*sk, F.col("validfrom").alias("sv_from"))
    return delta.join(sv, on=sk, how="left") \
        .filter(~F.coalesce(F.col("validdate") < F.col("sv_from"), F.lit(False))).drop("sv_from")


def _schedule_days(schedvers: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct (keys, validdate) inside the schedules' [validfrom, validthru]; a NULL end has no day."""
    spans = schedvers.groupBy(*keys, "validfrom").agg(F.max("validthru").alias("validthru"))
    return spans.select(*keys, F.explode(date_range("validfrom", "validthru")).alias("validdate")).distinct()


def merge_operday(
    base: DataFrame,
    delta: DataFrame,
    policy: str,
    delta_schedvers: DataFrame | None = None,
    ledger: DataFrame | None = None,
) -> DataFrame:
    """New operday = base days the policy keeps + the delta days (§2.1).

    * ``clip_delta``, ``clip_full``: drop delta days before their schedule's
      validfrom, then ``same_day`` or ``from_min``.
    * ``range_unit``: drop base days inside a delta schedule's [validfrom, validthru]
      of the same unit and owner whose import has the delta's unit code.
    * ``range``: the same without the unit-code condition.
    * ``same_day``: drop base days on a date the delta has for the same unit and owner.
    * ``from_min``: drop base days from the delta's first day of that unit and owner on.
    * ``append``: keep everything.
    A NULL validthru matches nothing (``between`` is unknown), as in SQL.  Ranges
    are expanded to their distinct days (bounded by one delivery's calendar), so
    every rule is an equi-join on unit, owner and date.
    """
    if policy not in POLICIES:
        raise ValueError(f"unknown merge policy {policy!r}")
    unit = ["organizationalunitcode", "dataownercode"]
    if policy in ("clip_delta", "clip_full"):
        delta = clip_to_schedules(delta, delta_schedvers)
        policy = "same_day" if policy == "clip_delta" else "from_min"
    if policy == "range_unit":
        units = ledger.select("version", "unitcode").distinct()
        days = _schedule_days(delta_schedvers.join(units, on="version"), [*unit, "unitcode"])
        kept = base.join(units, on="version", how="left").join(days, on=[*unit, "unitcode", "validdate"], how="left_anti")
    elif policy == "range":
        kept = base.join(_schedule_days(delta_schedvers, unit), on=[*unit, "validdate"], how="left_anti")
    elif policy == "same_day":
        kept = base.join(delta.select(*unit, "validdate").distinct(), on=[*unit, "validdate"], how="left_anti")
    elif policy == "from_min":
        first = delta.groupBy(*unit).agg(F.min("validdate").alias("first_day"))
        kept = base.join(first, on=unit, how="left").filter(
            ~F.coalesce(F.col("validdate") >= F.col("first_day"), F.lit(False))).drop("first_day")
    else:
        kept = base
    return kept.select(*base.columns).unionByName(delta.select(*base.columns))


def merge_many(days: DataFrame, deliveries: DataFrame, schedvers: DataFrame | None = None, ledger: DataFrame | None = None) -> DataFrame:
    """What merging deliveries one after the other (:func:`merge_operday`) leaves, in one job.

    ``days``: the operating days of all deliveries with their number ``delivery`` (merged in ascending
    order; the days there before have a number below all others); ``deliveries``: (delivery,
    policy), one row each; ``schedvers`` with ``delivery``; ``ledger``: (version, unitcode) of all versions.

    A day stays if no later delivery removes it, that is, if the last delivery that removes days like it
    is not later than its own.  Deliveries remove single days (same_day, range,
    range_unit), of which the last per unit, owner and date is a grouped maximum, or all days
    from a first one on (from_min), of which the last is a running maximum over the dates of
    one unit and owner: a sweep over as many rows as there are dates and deliveries.
    Returns ``days`` without the removed ones.
    """
    unit = ["organizationalunitcode", "dataownercode"]
    how = deliveries.select(F.col("delivery").alias("of"), "policy").distinct()
    clips = how.filter(F.col("policy").startswith("clip"))
    columns = days.columns
    if schedvers is not None:
        sk = ["version", "dataownercode", "organizationalunitcode", "schedulecode", "scheduletypecode", "delivery"]
        starts = schedvers.join(clips, F.col("delivery") == F.col("of"), "left_semi").select(*[F.col(c).alias(f"s_{c}") for c in sk], F.col("validfrom").alias("s_from"))
        same = F.lit(True)
        for c in sk:
            same = same & (F.col(c) == F.col(f"s_{c}"))
        days = days.join(starts, same, "left").filter(~F.coalesce(F.col("validdate") < F.col("s_from"), F.lit(False))).select(*columns)
    by = days.join(how, F.col("delivery") == F.col("of")).select(*unit, "validdate", "delivery", "policy")
    single = by.filter(F.col("policy").isin("same_day", "clip_delta")).select(*unit, "validdate", "delivery")
    exact = None
    if schedvers is not None:
        spans = schedvers.join(how, F.col("delivery") == F.col("of")).filter(F.col("policy").isin("range", "range_unit"))
        single = single.unionByName(spans.filter("policy = 'range'").select(*unit, F.explode(date_range("validfrom", "validthru")).alias("validdate"), "delivery"))
        if ledger is not None:
            units = ledger.select(F.col("version").alias("v"), "unitcode").distinct()
            exact = spans.filter("policy = 'range_unit'").join(units, F.col("version") == F.col("v")) \
                .select(*unit, "unitcode", F.explode(date_range("validfrom", "validthru")).alias("validdate"), "delivery") \
                .groupBy(*[F.col(c).alias(f"u_{c}") for c in (*unit, "unitcode", "validdate")]).agg(F.max("delivery").alias("last_unit"))
    onward = by.filter(F.col("policy").isin("from_min", "clip_full")).groupBy(*unit, "delivery").agg(F.min("validdate").alias("validdate"))
    dates = days.select(*unit, "validdate").distinct().withColumn("delivery", F.lit(None).cast(days.schema["delivery"].dataType))
    sweep = Window.partitionBy(*unit).orderBy("validdate").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    swept = dates.unionByName(onward.select(*dates.columns)).withColumn("last", F.max("delivery").over(sweep)).filter("delivery is null and last is not null") \
        .select(*unit, "validdate", F.col("last").alias("delivery"))
    last = single.unionByName(swept.select(*single.columns)).groupBy(*[F.col(c).alias(f"l_{c}") for c in (*unit, "validdate")]).agg(F.max("delivery").alias("last_any"))

    def like(prefix: str, names: list[str]) -> Column:
        out = F.lit(True)
        for c in names:
            out = out & (F.col(c) == F.col(f"{prefix}_{c}"))
        return out

    out = days.join(last, like("l", [*unit, "validdate"]), "left")
    later = F.coalesce(F.col("last_any") > F.col("delivery"), F.lit(False))
    if exact is not None:
        out = out.join(units, F.col("version") == F.col("v"), "left").join(exact, like("u", [*unit, "unitcode", "validdate"]), "left")
        later = later | F.coalesce(F.col("last_unit") > F.col("delivery"), F.lit(False))
    return out.filter(~later).select(*columns)


# ---- N-8 -------------------------------------------------------------------

def purge_expired(ledger: DataFrame, operday: DataFrame, as_of) -> DataFrame:
    """Refresh each version's validthru to its last operating day and flag the
    versions to move to the tombstones (validthru before ``as_of - 1`` or
    NULL).  Returns the ledger with ``validthru`` refreshed and ``purged``."""
    last = operday.groupBy("version").agg(F.max("validdate").alias("last_day"))
    ref = ledger.drop("validthru").join(last, on="version", how="left").withColumnRenamed("last_day", "validthru")
    flag = F.coalesce(F.col("validthru") < F.date_sub(_date(as_of), 1), F.lit(True))
    return ref.withColumn("purged", flag)


def any_purged(refreshed_ledger: DataFrame) -> DataFrame:
    """One row: did the purge move any version to the tombstones? (E-12, ``bool_or``)."""
    return refreshed_ledger.agg(F.coalesce(F.bool_or("purged"), F.lit(False)).alias("changed"))


def cascade_live(df: DataFrame, live_ledger: DataFrame) -> DataFrame:
    """Drop rows of versions no longer in the ledger (K-6, B-6 cascade)."""
    return df.join(live_ledger.select("version").distinct(), on="version", how="left_semi")


# ---- N-2, L-1, L-3, L-4 ----------------------------------------------------

def plan_imports(index: DataFrame, ledger: DataFrame, force_baseline_keys: tuple[str, ...] = (),
                 publish_col: str | None = None) -> DataFrame:
    """Deliveries to import, in import order (N-2, L-1, L-4).

    Published index entries whose (key, owner version) is neither live nor
    purged in the ledger; baselines first, then by index and publication
    order.  Keys in ``force_baseline_keys`` count as baselines.
    """
    idx = index
    if force_baseline_keys:
        idx = idx.withColumn("isbaseline", F.col("isbaseline") | F.col("feedkey").isin(*force_baseline_keys))
    seen = ledger.select("feedkey", "dataownerversion").distinct()
    todo = idx.filter(F.col("ispublished")).join(seen, on=["feedkey", "dataownerversion"], how="left_anti")
    publish_col = publish_col or ("publishorder" if "publishorder" in index.columns else "publishdate")
    return todo.orderBy(F.col("isbaseline").desc(), F.col("idx"), F.col(publish_col), F.col("feedkey"))


def import_positions(plan: DataFrame, publish_col: str = "publishorder") -> DataFrame:
    """The plan with ``position`` (int, from 1): numbered within (baseline, index), plus the
    deliveries of earlier ones.  Nothing runs until the result is read."""
    parts = plan.withColumn("__all", F.lit(0)).withColumn("__part", F.struct((~F.col("isbaseline")).alias("later"), "idx"))
    return nested_rank(parts, ["__all"], "__part", [publish_col, "feedkey"], "position", "row_number").drop("__all", "__part")


def unpublished_keys(index: DataFrame) -> DataFrame:
    """Keys whose delivery was withdrawn: their import is deleted (L-4)."""
    return index.filter(~F.col("ispublished")).select("feedkey").distinct()


def drop_unpublished(ledger: DataFrame, index: DataFrame) -> DataFrame:
    return ledger.join(unpublished_keys(index), on="feedkey", how="left_anti")


def manifest_diff(new: DataFrame, old: DataFrame) -> DataFrame:
    """Entries of the new index to fetch: unknown key or a higher version (L-3)."""
    o = old.groupBy("feedkey").agg(F.max("dataownerversion").alias("old_version"))
    j = new.join(o, on="feedkey", how="left")
    return j.filter(F.col("old_version").isNull() | (F.col("dataownerversion") > F.col("old_version"))) \
        .drop("old_version")
