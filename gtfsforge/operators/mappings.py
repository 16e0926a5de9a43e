"""Mapping constants of the GTFS export (K-4), as small DataFrames.

Every table here is a literal of a few dozen rows, so its size is bounded by
construction and it is safe to broadcast.  Callers may pass their own
DataFrames with the same columns instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# ---- fixed values (must equal the reference's mapping tables) ----
ROUTE_TYPES = [("TRAM", 0), ("METRO", 1), ("TRAIN", 2), ("BUS", 3), ("BOAT", 4)]
WHEELCHAIR = [("UNKNOWN", 0), ("ACCESSIBLE", 1), ("NOTACCESSIBLE", 2)]
PRODUCT_FORMULAS = [
    (1, "Buurtbus"), (2, "Belbus"), (3, "Express-bus"), (4, "Fast Ferry"), (5, "Hanze-Liner"),
    (6, "Interliner"), (7, "Kamperstadslijn"), (8, "Lijntaxi"), (9, "Media express"), (10, "MAXX"),
    (11, "Natuurexpress"), (12, "Niteliner"), (13, "Q-liner"), (14, "Regioliner"), (15, "Servicebus"),
    (16, "Sneldienst"), (17, "Spitsbus"), (19, "Sternet"), (20, "Sneltram"), (21, "Tram"),
    (22, "Vierdaagse"), (23, "Waterbus"), (24, "Zuidtangent"), (25, "Stoptrein"), (26, "Sneltrein"),
    (27, "Intercity"), (28, "Sprinter"), (29, "Internationale Trein"), (30, "HSL Zuid"), (31, "ICE"),
    (32, "Thalys"), (33, "Valleilijn"), (34, "Breng"), (35, "Opstapper"), (36, "Overstapper"),
    (37, "R-NET"), (38, "Parkshuttle"), (39, "FC-Utrecht Express"),
]
# product formulas whose stops are on demand (pickup / drop-off type 3)
ON_DEMAND_FORMULAS = (2, 35, 36)
# product formula excluded when picking a pattern's formula
IGNORED_FORMULA = 18
BIKES_ALLOWED = [
    ("GVB", "900", 2), ("GVB", "901", 2), ("GVB", "902", 2), ("GVB", "904", 2), ("GVB", "905", 2),
    ("GVB", "906", 2), ("GVB", "907", 2), ("GVB", "26", 2), ("GVB", "50", 2), ("GVB", "51", 2),
    ("GVB", "52", 2), ("GVB", "53", 2), ("GVB", "54", 2), ("CXX", "N419", 2), ("CXX", "Z020", 2),
    ("CXX", "Z050", 2), ("CXX", "Z060", 2), ("VTN", "26", 2), ("ARR", "17090", 2), ("ARR", "17194", 2),
    ("ARR", "17196", 2), ("ARR", "15020", 2), ("ARR", "15021", 2), ("ARR", "15022", 2), ("ARR", "15023", 2),
    ("ARR", "15024", 2),
]
# deprecated product-formula codes per owner (N-36): (owner, deprecated, formula)
FORMULA_FIXES = [("VTN", "buur", 1), ("VTN", "belb", 2), ("ARR", "Bubu", 1)]
# agencies of the KV1 feeds: (agency_id, name, url)
KV1_AGENCIES = [
    ("ARR", "Arriva", "http://www.arriva.nl/"),
    ("BRENG", "Breng", "http://www.breng.nl/"),
    ("CXX", "Connexxion", "http://www.connexxion.nl/"),
    ("EBS", "EBS", "http://www.ebs-ov.nl/"),
    ("GVB", "GVB", "http://www.gvb.nl/"),
    ("GVU", "GVU", "http://www.gvu.nl/"),
    ("HERMES", "Hermes", "http://www.hermes.nl/"),
    ("HTM", "HTM", "http://www.htm.nl/"),
    ("HTMBUZZ", "HTMbuzz", "http://www.htm.nl/"),
    ("QBUZZ", "Qbuzz", "http://www.qbuzz.nl/"),
    ("RET", "RET", "http://www.ret.nl/"),
    ("SYNTUS", "Syntus", "http://www.syntus.nl/"),
    ("VTN", "Veolia", "http://www.veolia.nl/"),
]
AGENCY_TIMEZONE = "Europe/Amsterdam"
AGENCY_LANG = "nl"
# feed_info publisher (name, url, language): a deployment setting, passed by the
# caller of gtfs_feed_info; this neutral default is used when none is given
FEED_PUBLISHER = ("feed publisher", "http://example.org/", "nl")
# IFF company number -> agency url
COMPANY_URLS = [
    (22, "http://www.gvb.nl"), (911, "http://www.keolis.de"), (500, "http://www.arriva.nl"),
    (23, "http://www.htm.nl"), (600, "http://www.connexxion.nl"), (805, "http://www.connexxion.nl"),
    (24, "http://www.ret.nl"), (980, "http://www.sncf.fr"), (910, "http://www.db.de"),
    (920, "http://www.nmbs.be"), (700, "http://www.veolia.nl"), (701, "http://www.veolia.nl"),
    (35, "http://www.ebs-ov.nl"), (400, "http://www.syntus.nl"), (801, "http://www.syntus.nl"),
    (750, "http://www.qbuzz.nl"), (100, "http://www.ns.nl"), (37, "http://www.ns.nl"),
    (25, "http://www.gvu.nl"), (200, "http://www.ns-hispeed.nl"), (960, "http://www.ns-hispeed.nl"),
    (300, "http://www.thalys.nl"), (501, "http://www.breng.nl"), (52, "http://www.breng.nl"),
    (54, "http://www.valleilijn.nl"),
]
# rail v3 differs in these
COMPANY_URLS_V3 = [(25, "http://www.ns.nl"), (999, "http://www.eurostar.com")]
# PAS modality -> GTFS route type
PAS_ROUTE_TYPES = [("T", 0), ("M", 1), ("B", 3), ("H", 3), ("F", 4)]
# ---- end of fixed values ----


def route_types(spark: SparkSession) -> DataFrame:
    return F.broadcast(spark.createDataFrame(ROUTE_TYPES, "transporttype string, route_type int"))


def wheelchair(spark: SparkSession) -> DataFrame:
    return F.broadcast(spark.createDataFrame(WHEELCHAIR, "wheelchairaccessible string, wheelchair_accessible int"))


def product_formulas(spark: SparkSession) -> DataFrame:
    return F.broadcast(spark.createDataFrame(PRODUCT_FORMULAS, "productformulatype int, localized_route_type string"))


def bikes_allowed(spark: SparkSession) -> DataFrame:
    return F.broadcast(spark.createDataFrame(
        BIKES_ALLOWED, "dataownercode string, lineplanningnumber string, trip_bikes_allowed int"))


def formula_fixes(spark: SparkSession) -> DataFrame:
    return F.broadcast(spark.createDataFrame(FORMULA_FIXES, "dataownercode string, deprecated string, fixed_formula int"))


def kv1_agencies(spark: SparkSession) -> DataFrame:
    return F.broadcast(spark.createDataFrame(KV1_AGENCIES, "agency_id string, agency_name string, agency_url string"))


def company_urls(spark: SparkSession, version: int = 1) -> DataFrame:
    urls = dict(COMPANY_URLS) | (dict(COMPANY_URLS_V3) if version == 3 else {})
    return F.broadcast(spark.createDataFrame(list(urls.items()), "company int, agency_url string"))


def pas_route_types(spark: SparkSession) -> DataFrame:
    return F.broadcast(spark.createDataFrame(PAS_ROUTE_TYPES, "modaliteit string, route_type int"))
