"""Readers on literal feed files: KV1, zip archives, IFF, PAS, feed index, sinks."""

import datetime as dt
import io
import zipfile

from pyspark.sql import functions as F

from gtfsforge.sources import archives, iff, index, kv1, pas
from gtfsforge.sources.charsets import translation
from gtfsforge import sinks


def _write(path, text, charset):
    path.write_bytes(text.encode(charset))
    return str(path)


def test_charset_tables_are_derived():
    src, dst = translation("ISO-8859-15")
    assert len(src) == 8 and "€" in dst and "Š" in dst
    src, dst = translation("cp1252")
    assert "€" in dst and "’" in dst


def test_kv1_reader_header_charset_dialect(spark, tmp_path):
    usrstop = (
        "[USRSTOP]|VersionNumber|Implicit|DataOwnerCode|UserStopCode|TimingPointCode|GetIn|GetOut|Deprecated|Name|Town|"
        "UserStopAreaCode|StopSideCode|RoadSideEqDataOwnerCode|RoadSideEqUnitNumber|MinimalStopTime|StopSideLength|"
        "Description|UserStopType\r\n"
        "USRSTOP|1|I|QBUZZ|1001|5001|true|false||Caf€ Š|Town|A1||||0|||PASSENGER\r\n"
        "USRSTOP|1|I|QBUZZ|1002||false|true||\"Quoted|Name\"|Town|||||30|||\r\n"
    )
    p = _write(tmp_path / "USRSTOP.TMI", usrstop, "iso8859_15")
    df = kv1.read_kv1(spark, p, "usrstop", charset="ISO-8859-15")
    rows = {r["userstopcode"]: r for r in df.collect()}
    assert set(rows) == {"1001", "1002"}
    assert rows["1001"]["name"] == "Caf€ Š"
    assert rows["1001"]["getin"] is True and rows["1001"]["getout"] is False
    assert rows["1002"]["name"] == "Quoted|Name"
    assert rows["1002"]["timingpointcode"] is None
    assert rows["1002"]["minimalstoptime"] == 30
    assert dict(df.dtypes)["version"] == "int"


def test_kv1_times_and_veolia_dialect(spark, tmp_path):
    text = ("PUJOPASS|1|I|VTN|U1|S1|WE|12|1001|1|12001|40010||23:58:00\n"
            "PUJOPASS|1|I|VTN|U1|S1|WE|12|1001|2|12001|40020|24:04|24:04:30\n")
    p = _write(tmp_path / "PUJOPASS.TMI", text, "utf-8")
    df = kv1.read_kv1(spark, p, "pujopass", dialect="veolia")
    rows = sorted(df.collect(), key=lambda r: r["stoporder"])
    assert rows[0]["arr_s"] is None and rows[0]["dep_s"] == 23 * 3600 + 58 * 60
    assert rows[1]["arr_s"] == 24 * 3600 + 4 * 60 and rows[1]["dep_s"] == 24 * 3600 + 4 * 60 + 30
    # columns the dialect does not deliver come back as typed NULLs
    assert rows[0]["wheelchairaccessible"] is None and "dataownerisoperator" in df.columns


def test_zip_archives_nested(spark, tmp_path):
    inner = io.BytesIO()
    with zipfile.ZipFile(inner, "w") as z:
        z.writestr("Csv/DEST.csv", "DEST|3|I|ARR|D1|Centraal|Centraal|||\r\nDEST|3|I|ARR|D2|Noord|Noord|||\r\n")
        z.writestr("Csv/LINEX.csv", "LINE|3|I|ARR|15012|12|Lijn 12|12||BOAT\r\n")
    outer = tmp_path / "feed.zip"
    with zipfile.ZipFile(outer, "w") as z:
        z.writestr("Csv.zip", inner.getvalue())
    lines = archives.expand_archives(spark, str(tmp_path))
    got = sorted((r["table"], r["line"][:8]) for r in lines.collect())
    assert [t for t, _ in got] == ["dest", "dest", "line"]
    dest = kv1.parse_lines(lines.filter(F.col("table") == "dest"), "dest")
    assert sorted(r["destnamefull"] for r in dest.collect()) == ["Centraal", "Noord"]
    line = kv1.parse_lines(lines.filter(F.col("table") == "line"), "line").first()
    assert line["transporttype"] == "BOAT" and line["linevetagnumber"] == 12


IFF_DELIVERY = "@100,01012024,31122024,0001,sample"
TIMETABLE = (
    IFF_DELIVERY + "\r\n"
    "#00000001\r\n"
    "%100,01234,      ,001,003,                              \r\n"
    "-00007,000,999\r\n"
    "&IC  ,001,003\r\n"
    "*NIIN,002,002,00000\r\n"
    ">aaa    ,2350\r\n"
    "?5a   ,5a   ,00007\r\n"
    ";xxx    \r\n"
    "+bbb    ,0004,0006\r\n"
    "?2    ,3    ,00007\r\n"
    "<ccc    ,0031\r\n"
    "#00000002\r\n"
    "%100,00000,      ,001,002,                              \r\n"
    "-00000,000,999\r\n"
    "&SPR ,001,002\r\n"
    ">ccc    ,0100\r\n"
    "<aaa    ,0130\r\n"
)


def _iff_dir(tmp_path):
    d = tmp_path / "iff"
    d.mkdir()
    files = {
        "delivery": IFF_DELIVERY + "\r\n",
        "timetbls": TIMETABLE,
        "stations": IFF_DELIVERY + "\r\n0,aaa    ,02,00,NL  ,0,0,015500,046300,Aaa Centraal\r\n"
                    "2,bbb    ,03,00,NL  ,0,0,015600,046400,Bbb\r\n1,ccc    ,05,00,GB  ,1,0,015700,046500,Ccc Caf\xe9\r\n",
        "company": IFF_DELIVERY + "\r\n100,ns        ,NS                  ,0400\r\n",
        "country": IFF_DELIVERY + "\r\nNL  ,1,Nederland\r\nGB  ,0,Engeland\r\n",
        "trnsmode": IFF_DELIVERY + "\r\nIC  ,Intercity\r\nSPR ,Sprinter\r\n",
        "trnsattr": IFF_DELIVERY + "\r\nNIIN,1,Niet instappen\r\n",
        "connmode": IFF_DELIVERY + "\r\n2,1,Walk\r\n",
        "contconn": IFF_DELIVERY + "\r\naaa    ,bbb    ,05,2\r\n",
        "timezone": IFF_DELIVERY + "\r\n#0000\r\n+00,01012024,31122024\r\n#0001\r\n-01,01012024,31122024\r\n",
        "footnote": IFF_DELIVERY + "\r\n#00007\r\n1101\r\n#00000\r\n0010\r\n",
        "changes": IFF_DELIVERY + "\r\n#bbb    \r\n-00001,00002,01\r\n-00003,00004,02\r\n#ccc    \r\n-00001,00002,00\r\n",
        "trnsaqst": IFF_DELIVERY + "\r\n#NIIN,1,Instappen?\r\n-NIIN\r\n-NUIT\r\n",
    }
    for name, text in files.items():
        (d / f"{name}.dat").write_bytes(text.encode("cp1252"))
    return str(d)


def test_iff_reader(spark, tmp_path):
    base = _iff_dir(tmp_path)
    t = iff.read_iff(spark, base)
    d = t["delivery"].first()
    assert d["companynumber"] == 100 and d["firstday"] == dt.date(2024, 1, 1) and d["versionnumber"] == 1
    stops = sorted((r["serviceid"], r["idx"], r["station"], r["arr_s"], r["dep_s"]) for r in t["stop"].collect())
    assert stops == [
        (1, 1, "aaa", None, 23 * 3600 + 50 * 60), (1, 2, "xxx", None, None), (1, 3, "bbb", 240, 360),
        (1, 4, "ccc", 31 * 60, None), (2, 1, "ccc", None, 3600), (2, 2, "aaa", 5400, None)]
    plats = sorted((r["idx"], r["station"], r["arrival"], r["departure"]) for r in t["platform"].collect())
    assert plats == [(1, "aaa", "5a", "5a"), (3, "bbb", "2", "3")]
    svc = {r["serviceid"]: r for r in t["service"].collect()}
    assert svc[2]["servicenumber"] == 0 and svc[1]["variant"] is None  # zeros stay zeros (D1)
    v = {r["serviceid"]: r["footnote"] for r in t["validity"].collect()}
    assert v == {1: 7, 2: 0}
    st = {r["shortname"]: r for r in t["station"].collect()}
    assert st["aaa"]["trainchanges"] == 0 and st["aaa"]["layovertime"] == 120 and st["aaa"]["x"] == 155000
    assert st["ccc"]["name"] == "Ccc Caf\xe9" and st["ccc"]["timezone"] == 1
    assert {r["code"]: r["inland"] for r in t["country"].collect()} == {"NL": True, "GB": False}
    tz = sorted((r["tznumber"], r["difference"]) for r in t["timezone"].collect())
    assert tz == [(0, 0), (1, -1)]
    ch = sorted((r["station"], r["fromservice"], r["toservice"], r["possiblechange"]) for r in t["changes"].collect())
    assert ch == [("bbb", 1, 2, 1), ("bbb", 3, 4, 2), ("ccc", 1, 2, 0)]  # one list per station (D3)
    q = sorted((r["code"], r["transattr"]) for r in t["trnsaqst"].collect())
    assert q == [("NIIN", "NIIN"), ("NIIN", "NUIT")]
    fdates = iff.footnote_dates(t["footnote_bits"], d["firstday"])
    got = sorted((r["footnote"], r["servicedate"].day) for r in fdates.collect())
    assert got == [(0, 3), (7, 1), (7, 2), (7, 4)]
    assert t["contconn"].first()["connectiontime"] == 300
    checks = {r["file"]: r["matches_delivery"] for r in iff.check_delivery(spark, base, ["stations", "company"]).collect()}
    assert checks == {"stations": True, "company": True}


def test_pas_reader(spark, tmp_path):
    hlt = tmp_path / "RET.HLT"
    hlt.write_bytes(("0,HA1   ,0,0,NL,0,0,92000,437000,Centraal,,,,1,,,\r\n"
                     "0,HA2   ,0,0,NL,0,0,93000,438000,Remise Noord,,,,1,,,\r\n").encode("cp1252"))
    stops = pas.read_stops(spark, str(hlt))
    assert sorted(r["halteid"] for r in stops.collect()) == ["HA1", "HA2"]
    assert stops.filter("halteid = 'HA1'").first()["x"] == 92000
    p = tmp_path / "RET.PAS"
    p.write_bytes(("!RETPAS1\r\n&01012024-31012024\r\n"
                   "#M,RET,001,1,12345\r\n-00001\r\n>HA1   ,2350\r\n+HA2   ,2358,2359\r\n.HA1   ,0003\r\n<HA2   ,0010\r\n"
                   "#M,RET,001,2,12346\r\n-00002\r\n>HA2   ,0600\r\n<HA1   ,0610\r\n").encode("cp1252"))
    j = pas.read_journeys(spark, str(p))
    assert j["period"].first()["validfrom"] == dt.date(2024, 1, 1)
    assert j["format"].first()["format_ok"] is True
    pujo = sorted((r["ritnummer"], r["voetnoot"], r["richting"]) for r in j["pujo"].collect())
    assert pujo == [("12345", "00001", 1), ("12346", "00002", 2)]
    passes = sorted((r["ritnummer"], r["stopsequentie"], r["arr_s"], r["dep_s"]) for r in j["pujopass"].collect())
    day = 86400
    assert passes[:4] == [("12345", 1, None, 23 * 3600 + 50 * 60), ("12345", 2, 23 * 3600 + 58 * 60, 23 * 3600 + 59 * 60),
                          ("12345", 3, day + 180, day + 180), ("12345", 4, day + 600, None)]
    v = tmp_path / "RET.VTN"
    v.write_bytes("@00001,1010\r\n@00002,0001\r\n".encode("cp1252"))
    vt = pas.read_footnotes(spark, str(v), dt.date(2024, 1, 1))
    assert sorted((r["voetnoot"], r["datum"].day) for r in vt.collect()) == [("00001", 1), ("00001", 3), ("00002", 4)]


def test_feed_index(spark, tmp_path):
    x = tmp_path / "index.xml"
    x.write_text(
        "<kv1index><mutatiedatum>2024-01-02</mutatiedatum>"
        '<periode key="k1"><zipfile>a.zip</zipfile><versie>2</versie><isgepubliceerd>true</isgepubliceerd>'
        "<publicatiedatum>2024-01-01</publicatiedatum><isbaseline>true</isbaseline><startdatum>2024-01-01</startdatum>"
        "<einddatum>2024-03-01</einddatum><index>1</index></periode>"
        '<periode key="k2"><zipfile>b.zip</zipfile><versie>1</versie><isgepubliceerd>false</isgepubliceerd>'
        "<publicatiedatum>2024-01-05</publicatiedatum><isbaseline>false</isbaseline><startdatum>2024-02-01</startdatum>"
        "<einddatum>2024-03-01</einddatum><index>2</index></periode></kv1index>")
    m = {r["feedkey"]: r for r in index.read_feed_index(spark, str(x)).collect()}
    assert m["k1"]["dataownerversion"] == 2 and m["k1"]["ispublished"] and m["k1"]["isbaseline"]
    assert m["k2"]["ispublished"] is False and m["k2"]["validfrom"] == dt.date(2024, 2, 1)


def test_sinks_write_header_even_when_empty(spark, tmp_path):
    out = str(tmp_path / "gtfs")
    shapes = sinks.empty_table(spark, "shape_id string, shape_pt_lat double, shape_pt_lon double, shape_pt_sequence int")
    st = spark.createDataFrame([("t1", "00:00:00", 2), ("t1", "00:01:00", 1)],
                               "trip_id string, arrival_time string, stop_sequence int")
    sinks.write_feed({"shapes": shapes, "stop_times": st}, out)
    back = spark.read.option("header", True).csv(out + "/shapes")
    assert back.columns == ["shape_id", "shape_pt_lat", "shape_pt_lon", "shape_pt_sequence"]
    got = [r["stop_sequence"] for r in spark.read.option("header", True).csv(out + "/stop_times").collect()]
    assert sorted(got) == ["1", "2"]


def test_kv1_delivery_folder_with_owner_charset(spark, tmp_path):
    d = tmp_path / "kv1"
    d.mkdir()
    (d / "OPERDAY.TMI").write_bytes("OPERDAY|1|I|QBUZZ|U1|S1|WE|2030-01-02|\r\n".encode("iso8859_15"))
    (d / "DEST.TMI").write_bytes("DEST|1|I|QBUZZ|D1|Caf€|Caf€|||\r\n".encode("iso8859_15"))
    (d / "README.txt").write_bytes(b"not a table")
    t = kv1.read_delivery(spark, str(d))
    assert set(t) == {"dest", "operday"}
    assert t["dest"].first()["destnamefull"] == "Caf€"  # QBUZZ delivers ISO-8859-15


def test_archive_lines_are_cut_at_line_ends_only(spark):
    from gtfsforge.sources.archives import split_lines

    odd = "".join(chr(c) for c in (0x85, 0x0B, 0x0C, 0x1C, 0x1D, 0x1E))
    text = ["DEST|1|Århus", f"DEST|2|a{odd}b", 'DEST|3|"two\nlines"|x', 'DEST|4|"quoted ""here"""', 'DEST|5|say "hi', "DEST|6|end"]
    data = "\r\n".join(text).encode("utf-8")
    got = [x.encode("latin-1").decode("utf-8") for x in split_lines(data)]
    assert got == text
    assert list(split_lines(b'a|"open\r\nb\nc')) == ['a|"open', "b", "c"]
    for size in (1, 2, 5, 1000):  # parts of any length give the same lines
        parts = [data[i:i + size] for i in range(0, len(data), size)]
        assert [x.encode("latin-1").decode("utf-8") for x in split_lines(parts)] == text
    # a quote that is not closed soon is text, and later quotes count again
    late = b'a|"open\n' + b"b\n" * 20 + b'c|"two\nlines"\n'
    assert list(split_lines(late, field=30))[-2:] == ['c|"two\nlines"', ""]


def test_an_unclosed_quote_costs_linear_time():
    import time

    from gtfsforge.sources.archives import split_lines

    def seconds(n):
        t = time.perf_counter()
        assert sum(1 for _ in split_lines(b'x|"open\n' + b'PUJOPASS|1|""|x\n' * n)) == n + 2
        return time.perf_counter() - t

    seconds(1000)
    assert seconds(1_000_000) < 20 * max(0.02, seconds(100_000))


def test_members_and_stretches_have_tasks_of_their_own(spark, tmp_path, monkeypatch):
    """A member is read by one task, its lines by many; a long one is cut at line ends only."""
    text = "".join(f'DEST|3|I|ARR|D{k}|"Name {k}\nsecond"|x|||\r\n' for k in range(60_000))
    with zipfile.ZipFile(tmp_path / "big.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("DEST.TMI", text)
        z.writestr("empty.TMI", "")
        z.writestr(zipfile.ZipInfo("LINE.TMI"), "LINE|3|I|ARR|1|1|n|||BUS\n" * 3)  # stored, not deflated
    lines = archives.expand_archives(spark, str(tmp_path))
    got = lines.withColumn("task", F.spark_partition_id())
    assert got.where("table = 'dest'").count() == 60_000 and got.where("table = 'line'").count() == 3
    stretches = list(archives._stretches(iter(archives_slices(tmp_path / "big.zip"))))
    assert sum(b.column(2)[0].as_py() == "dest" for b in stretches) >= 2
    names = {r["destnamefull"] for r in kv1.parse_lines(lines.where("table = 'dest'"), "dest").where("destcode in ('D0', 'D59999')").collect()}
    assert names == {"Name 0\nsecond", "Name 59999\nsecond"}


def archives_slices(path):
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array([str(path)]), pa.array([path.read_bytes()], pa.binary())], names=["path", "content"])
    return archives._list(iter([batch]))


def test_quotes_inside_quoted_fields(spark, tmp_path):
    (tmp_path / "DEST.TMI").write_bytes(b'DEST|3|I|ARR|D1|"say ""hi"" | there"|x|||\n')
    assert kv1.read_kv1(spark, str(tmp_path / "DEST.TMI"), "dest").first()["destnamefull"] == 'say "hi" | there'


def test_a_malformed_byte_is_null_and_counted(spark):
    from gtfsforge.sources import kv1

    good, bad = "DEST|1|I|ARR|D1|Århus|Å|||", b"DEST|1|I|ARR|D2|\xff\xfe|ok|||"
    df = spark.createDataFrame([(good.encode().decode("latin-1"),), (bad.decode("latin-1"),)], "line string")
    rows = {r["destcode"]: r["destnamefull"] for r in kv1.parse_lines(df, "dest").collect()}
    assert rows == {"D1": "Århus", "D2": None}
    raw = kv1.raw_lines(df, "dest")
    assert [tuple(r) for r in kv1.count_undecodable(raw, "dest").collect()] == [("dest", "destnamefull", 1)]


def test_the_timetable_is_read_once_for_its_six_tables(spark, tmp_path):
    import os

    base = _iff_dir(tmp_path)
    t = iff.read_iff(spark, base, store=str(tmp_path / "records"))
    os.remove(f"{base}/timetbls.dat")  # nothing reads the text again
    want = {"service": 2, "validity": 2, "transport": 2, "attribute": 1, "platform": 2, "stop": 6}
    assert {k: t[k].count() for k in want} == want
    plan = t["platform"]._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(kind" in plan and "kind#" in plan and "timetbls" not in plan
    lazy = iff.parse_timetable_sections(spark.createDataFrame([("00000003", ["%100,00007,      ,001,002,", ">aaa    ,0100", "!unknown", "<bbb    ,0110"])], "head string, body array<string>"))
    assert {k: v.count() for k, v in lazy.items()} == {"service": 1, "validity": 0, "transport": 0, "attribute": 0, "platform": 0, "stop": 2}
