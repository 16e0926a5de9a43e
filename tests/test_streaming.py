"""Landing-folder import: two deliveries, idempotent replay, merged operating days."""

import datetime as dt
import io
import zipfile

from pyspark.sql import functions as F

from gtfsforge.streaming import landing


def _delivery(path, version, days, schedule):
    lines = "\r\n".join(f"OPERDAY|{version}|I|ARR|U1|{schedule}|WE|{d}|" for d in days) + "\r\n"
    pujo = f"PUJOPASS|{version}|I|ARR|U1|{schedule}|WE|12|1001|1|12001|40010||08:00:00|ACCESSIBLE|true\r\n"
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("OPERDAY.TMI", lines)
        z.writestr("PUJOPASS.TMI", pujo)
        z.writestr("DEST.TMI", f"DEST|{version}|I|ARR|D1|Centraal|Centraal|||\r\n")
    path.write_bytes(buf.getvalue())


def test_landing_import_merges_and_is_idempotent(spark, tmp_path):
    land, store, ckpt = tmp_path / "landing", tmp_path / "store", tmp_path / "ckpt"
    land.mkdir()
    _delivery(land / "a1.zip", 1, ["2030-01-01", "2030-01-02", "2030-01-03"], "S1")
    _delivery(land / "a2.zip", 1, ["2030-01-03", "2030-01-04"], "S2")
    q = landing.start_landing_import(spark, str(land), str(store), str(ckpt), policy="same_day",
                                     as_of=dt.date(2029, 12, 1))
    q.awaitTermination(300)
    ledger = landing.read_ledger(spark, str(store))
    assert sorted(r["filename"] for r in ledger.collect()) == ["a1.zip", "a2.zip"]
    assert sorted(r["version"] for r in ledger.collect()) == [1, 2]
    od = landing.current_operday(spark, str(store))
    got = sorted((r["version"], str(r["validdate"])) for r in od.collect())
    # same_day: the second delivery replaces day 3 of the first
    assert got == [(1, "2030-01-01"), (1, "2030-01-02"), (2, "2030-01-03"), (2, "2030-01-04")]
    # replaying a delivery that is already in the ledger changes nothing
    again = spark.read.format("binaryFile").load(str(land / "a2.zip"))
    assert landing.merge_delivery(spark, again, str(store), "a2.zip", as_of=dt.date(2029, 12, 1)) is False
    assert landing.read_ledger(spark, str(store)).count() == 2
    tables = spark.read.parquet(str(store / "tables" / "pujopass"))
    assert tables.select(F.countDistinct("version")).first()[0] == 2


def _archive(spark, path):
    return spark.read.format("binaryFile").load(str(path))


def _operday(spark, store):
    return sorted((r["version"], str(r["validdate"])) for r in landing.current_operday(spark, str(store)).collect())


def test_a_job_that_fails_before_the_ledger_is_simply_run_again(spark, tmp_path, monkeypatch):
    store = tmp_path / "store"
    _delivery(tmp_path / "a1.zip", 1, ["2030-01-01", "2030-01-02"], "S1")
    _delivery(tmp_path / "a2.zip", 1, ["2030-01-02", "2030-01-03"], "S2")
    as_of = dt.date(2029, 12, 1)
    assert landing.merge_delivery(spark, _archive(spark, tmp_path / "a1.zip"), str(store), "a1.zip", as_of=as_of)

    def broken(*args, **kwargs):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(landing, "_commit_ledger", broken)
        try:
            landing.merge_delivery(spark, _archive(spark, tmp_path / "a2.zip"), str(store), "a2.zip", as_of=as_of)
            raise AssertionError("should have failed")
        except RuntimeError:
            pass
    assert _operday(spark, store) == [(1, "2030-01-01"), (1, "2030-01-02")]
    assert landing.merge_delivery(spark, _archive(spark, tmp_path / "a2.zip"), str(store), "a2.zip", as_of=as_of)
    assert _operday(spark, store) == [(1, "2030-01-01"), (2, "2030-01-02"), (2, "2030-01-03")]
    passes = spark.read.parquet(str(store / "tables" / "pujopass"))
    assert sorted(r["version"] for r in passes.select("version").collect()) == [1, 2]
    # the current snapshots and the ones before, for jobs that still read them, are left
    assert len(list((store / "ledger").glob("snapshot=*"))) == len(list((store / "operday").glob("snapshot=*"))) == 2
    assert landing.sweep_folder(spark, str(tmp_path), str(store), as_of=as_of) == []


def test_index_sync_withdraws_imports_in_order_and_cascades(spark, tmp_path):
    store, folder = tmp_path / "store", tmp_path / "files"
    folder.mkdir()
    _delivery(folder / "base.zip", 1, ["2030-01-01", "2030-01-02", "2030-01-03"], "S1")
    _delivery(folder / "add.zip", 1, ["2030-01-02"], "S2")
    _delivery(folder / "old.zip", 1, ["2020-01-02"], "S3")
    cols = "feedkey string, filename string, dataownerversion int, ispublished boolean, isbaseline boolean, idx int, publishorder int"
    rows = [("k2", "add.zip", 1, True, False, 1, 2), ("k1", "base.zip", 1, True, True, 1, 1), ("k3", "old.zip", 1, True, False, 2, 3)]
    as_of = dt.date(2029, 12, 1)
    done = landing.sync_index(spark, spark.createDataFrame(rows, cols), str(folder), str(store), as_of=as_of, compress=True)
    assert done == ["k1", "k2", "k3"]
    assert _operday(spark, store) == [(1, "2030-01-01"), (1, "2030-01-03"), (2, "2030-01-02")]
    assert {p.name for p in (store / "tables").iterdir()} >= {"pujopass", "timdemgrp", "timdemrnt", "schedpujo"}
    assert landing.sync_index(spark, spark.createDataFrame(rows, cols), str(folder), str(store), as_of=as_of) == []
    rows[0] = (*rows[0][:3], False, *rows[0][4:])
    assert landing.sync_index(spark, spark.createDataFrame(rows, cols), str(folder), str(store), as_of=as_of) == []
    assert _operday(spark, store) == [(1, "2030-01-01"), (1, "2030-01-03")]
    assert [p.name for p in (store / "tables" / "pujopass").glob("version=*")] == ["version=1"]


def test_many_deliveries_at_once_equal_one_after_the_other(spark, tmp_path):
    """Owners and modes mixed: every policy that they choose, an expired delivery among them."""
    folder = tmp_path / "files"
    folder.mkdir()
    plan = []
    for k, owner in enumerate(["ARR", "GVB", "HTM", "QBUZZ", "SYNTUS", "ARR", "GVB", "HTM", "SYNTUS", "QBUZZ", "ARR"]):
        name = f"{k:02d}.zip"
        days = [f"2030-01-{1 + (k * 3 + j) % 28:02d}" for j in range(9)] if k != 5 else ["2020-05-05"]
        with zipfile.ZipFile(folder / name, "w") as z:
            z.writestr("OPERDAY.TMI", "\r\n".join(f"OPERDAY|1|I|{owner}|U{j % 2}|S{j % 3}|WE|{d}|" for j, d in enumerate(days)) + "\r\n")
            z.writestr("SCHEDVERS.TMI", "".join(f"SCHEDVERS|1|I|{owner}|U{u}|S{s}|WE|2030-01-0{1 + k % 5}|2030-01-{12 + k}|\r\n" for u in (0, 1) for s in range(3)))
        plan.append((str(folder / name), name, k % 4 != 3))
    as_of = dt.date(2029, 12, 1)
    for path, name, delta in plan:
        assert landing.merge_delivery(spark, _archive(spark, path), str(tmp_path / "one"), name, delta=delta, as_of=as_of)
    files = _archive(spark, folder)
    paths = {r["path"].rsplit("/", 1)[-1]: r["path"] for r in files.select("path").collect()}
    order = [landing.Delivery(paths[name], name, delta=delta) for _, name, delta in plan]
    assert landing.merge_deliveries(spark, files, str(tmp_path / "all"), order, as_of=as_of) == [name for _, name, _ in plan]

    def state(store):
        ledger = sorted(map(tuple, landing.read_ledger(spark, str(tmp_path / store)).collect()), key=str)
        return ledger, sorted(map(tuple, landing.current_operday(spark, str(tmp_path / store)).collect()), key=str)

    assert state("one") == state("all")
    assert landing.merge_deliveries(spark, files, str(tmp_path / "all"), order, as_of=as_of) == []


def test_merging_a_sequence_equals_merging_step_by_step(spark):
    import random

    from gtfsforge.operators import increment as I

    rnd = random.Random(5)
    day = lambda: dt.date(2030, 1, 1) + dt.timedelta(days=rnd.randrange(40))
    rows, sv, ledger, how = [], [], [], []
    for k in range(12):
        how.append((k, rnd.choice(I.POLICIES) if k else "append"))
        ledger.append((k, rnd.choice(["SGHR", "SGHB"])))
        for u, o, s in {(rnd.choice("UV"), rnd.choice(["ARR", "HTM"]), rnd.choice("ab")) for _ in range(4)}:
            rows += [(k, o, u, s, "WE", d, k) for d in {day() for _ in range(8)}]
            a, b = sorted((day(), day()))
            sv.append((k, o, u, s, "WE", a, b if rnd.random() < 0.8 else None, k))
    ddl = "version int, dataownercode string, organizationalunitcode string, schedulecode string, scheduletypecode string"
    days = spark.createDataFrame(rows, f"{ddl}, validdate date, delivery int")
    schedvers = spark.createDataFrame(sv, f"{ddl}, validfrom date, validthru date, delivery int")
    units = spark.createDataFrame(ledger, "version int, unitcode string")
    got = I.merge_many(days, spark.createDataFrame(how, "delivery int, policy string"), schedvers, units)
    base = days.filter("delivery = 0").drop("delivery")
    for k, policy in how[1:]:
        base = I.merge_operday(base, days.filter(F.col("delivery") == k).drop("delivery"), policy, schedvers.filter(F.col("delivery") == k).drop("delivery"), units)
        base = spark.createDataFrame(base.collect(), base.schema)
    assert sorted(map(tuple, got.drop("delivery").collect()), key=str) == sorted(map(tuple, base.collect()), key=str)


def test_sweep_by_name_reads_the_owners_charset(spark, tmp_path):
    folder, store = tmp_path / "files", tmp_path / "store"
    folder.mkdir()
    for name, owner, town in (("b.zip", "EBS", "Köln €".encode("iso8859-15")), ("a.zip", "ARR", "Århus".encode())):
        with zipfile.ZipFile(folder / name, "w") as z:
            z.writestr("OPERDAY.TMI", f"OPERDAY|1|I|{owner}|U1|S|WE|2030-01-01|\r\n")
            z.writestr("DEST.TMI", f"DEST|1|I|{owner}|D1|".encode() + town + b"|" + town + b"|||\r\n")
    assert landing.sweep_folder(spark, str(folder), str(store), as_of=dt.date(2029, 12, 1)) == ["a.zip", "b.zip"]
    got = {r["dataownercode"]: r["destnamefull"] for r in spark.read.parquet(str(store / "tables" / "dest")).collect()}
    assert got == {"EBS": "Köln €", "ARR": "Århus"}
