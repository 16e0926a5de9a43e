"""KV1 table schemas and per-operator dialects (B-1, §1.4).

A schema is the ordered column list of a pipe-delimited KV1 table with its
Spark type.  Dialects drop columns some operators do not deliver; the
reader then adds them back as typed NULLs so every downstream operator sees
one shape.  Keys are listed for the integrity checks (B-2, B-3).
"""

from __future__ import annotations

from pyspark.sql import types as T

S, I, L, B, D = "string", "int", "long", "boolean", "date"
HEAD = [("tablename", S), ("version", I), ("implicit", S), ("dataownercode", S)]

# table -> (columns after the common head, key columns besides version/owner)
KV1_TABLES: dict[str, tuple[list[tuple[str, str]], list[str]]] = {
    "dest": ([("destcode", S), ("destnamefull", S), ("destnamemain", S), ("destnamedetail", S),
              ("relevantdestnamedetail", S)], ["destcode"]),
    "line": ([("lineplanningnumber", S), ("linepublicnumber", S), ("linename", S), ("linevetagnumber", I),
              ("description", S), ("transporttype", S)], ["lineplanningnumber"]),
    "conarea": ([("concessionareacode", S), ("description", S)], ["concessionareacode"]),
    "confinrel": ([("confinrelcode", S), ("concessionareacode", S), ("financercode", S)], ["confinrelcode"]),
    "usrstar": ([("userstopareacode", S), ("name", S), ("town", S), ("roadsideeqdataownercode", S),
                 ("roadsideequnitnumber", I), ("description", S)], ["userstopareacode"]),
    "usrstop": ([("userstopcode", S), ("timingpointcode", S), ("getin", B), ("getout", B), ("deprecated", S),
                 ("name", S), ("town", S), ("userstopareacode", S), ("stopsidecode", S),
                 ("roadsideeqdataownercode", S), ("roadsideequnitnumber", I), ("minimalstoptime", I),
                 ("stopsidelength", I), ("description", S), ("userstoptype", S)], ["userstopcode"]),
    "point": ([("pointcode", S), ("validfrom", D), ("pointtype", S), ("coordinatesystemtype", S),
               ("locationx_ew", L), ("locationy_ns", L), ("locationz", I), ("description", S)], ["pointcode"]),
    "tili": ([("userstopcodebegin", S), ("userstopcodeend", S), ("minimaldrivetime", I), ("description", S)],
             ["userstopcodebegin", "userstopcodeend"]),
    "link": ([("userstopcodebegin", S), ("userstopcodeend", S), ("validfrom", D), ("distance", I),
              ("description", S), ("transporttype", S)],
             ["userstopcodebegin", "userstopcodeend", "validfrom", "transporttype"]),
    "pool": ([("userstopcodebegin", S), ("userstopcodeend", S), ("linkvalidfrom", D), ("pointdataownercode", S),
              ("pointcode", S), ("distancesincestartoflink", I), ("segmentspeed", I), ("localpointspeed", I),
              ("description", S), ("transporttype", S)],
             ["userstopcodebegin", "userstopcodeend", "linkvalidfrom", "pointdataownercode", "pointcode",
              "transporttype"]),
    "jopa": ([("lineplanningnumber", S), ("journeypatterncode", S), ("journeypatterntype", S), ("direction", I),
              ("description", S)], ["lineplanningnumber", "journeypatterncode"]),
    "jopatili": ([("lineplanningnumber", S), ("journeypatterncode", S), ("timinglinkorder", I),
                  ("userstopcodebegin", S), ("userstopcodeend", S), ("confinrelcode", S), ("destcode", S),
                  ("deprecated", S), ("istimingstop", B), ("displaypublicline", S), ("productformulatype", I)],
                 ["lineplanningnumber", "journeypatterncode", "timinglinkorder"]),
    "orun": ([("organizationalunitcode", S), ("name", S), ("organizationalunittype", S), ("description", S)],
             ["organizationalunitcode"]),
    "orunorun": ([("organizationalunitcodeparent", S), ("organizationalunitcodechild", S), ("validfrom", D)],
                 ["organizationalunitcodeparent", "organizationalunitcodechild", "validfrom"]),
    "specday": ([("specificdaycode", S), ("name", S), ("description", S)], ["specificdaycode"]),
    "pegr": ([("periodgroupcode", S), ("description", S)], ["periodgroupcode"]),
    "excopday": ([("organizationalunitcode", S), ("validdate", "timestamp"), ("daytypeason", I),
                  ("specificdaycode", S), ("periodgroupcode", S), ("description", S)],
                 ["organizationalunitcode", "validdate"]),
    "pegrval": ([("organizationalunitcode", S), ("periodgroupcode", S), ("validfrom", D), ("validthru", D)],
                ["organizationalunitcode", "periodgroupcode", "validfrom"]),
    "tive": ([("organizationalunitcode", S), ("timetableversioncode", S), ("periodgroupcode", S),
              ("specificdaycode", S), ("validfrom", D), ("timetableversiontype", S), ("validthru", D),
              ("description", S)],
             ["organizationalunitcode", "timetableversioncode", "periodgroupcode", "specificdaycode"]),
    "timdemgrp": ([("lineplanningnumber", S), ("journeypatterncode", S), ("timedemandgroupcode", S)],
                  ["lineplanningnumber", "journeypatterncode", "timedemandgroupcode"]),
    "timdemrnt": ([("lineplanningnumber", S), ("journeypatterncode", S), ("timedemandgroupcode", S),
                   ("timinglinkorder", I), ("userstopcodebegin", S), ("userstopcodeend", S), ("totaldrivetime", I),
                   ("drivetime", I), ("expecteddelay", I), ("layovertime", I), ("stopwaittime", I),
                   ("minimumstoptime", I)],
                  ["lineplanningnumber", "journeypatterncode", "timedemandgroupcode", "timinglinkorder"]),
    "pujo": ([("organizationalunitcode", S), ("timetableversioncode", S), ("periodgroupcode", S),
              ("specificdaycode", S), ("daytype", S), ("lineplanningnumber", S), ("journeynumber", I),
              ("timedemandgroupcode", S), ("journeypatterncode", S), ("departuretime", S),
              ("wheelchairaccessible", S), ("dataownerisoperator", B)],
             ["organizationalunitcode", "timetableversioncode", "periodgroupcode", "specificdaycode", "daytype",
              "lineplanningnumber", "journeynumber"]),
    "schedvers": ([("organizationalunitcode", S), ("schedulecode", S), ("scheduletypecode", S), ("validfrom", D),
                   ("validthru", D), ("description", S)],
                  ["organizationalunitcode", "schedulecode", "scheduletypecode"]),
    "operday": ([("organizationalunitcode", S), ("schedulecode", S), ("scheduletypecode", S), ("validdate", D),
                 ("description", S)],
                ["organizationalunitcode", "schedulecode", "scheduletypecode", "validdate"]),
    "pujopass": ([("organizationalunitcode", S), ("schedulecode", S), ("scheduletypecode", S),
                  ("lineplanningnumber", S), ("journeynumber", I), ("stoporder", I), ("journeypatterncode", S),
                  ("userstopcode", S), ("targetarrivaltime", S), ("targetdeparturetime", S),
                  ("wheelchairaccessible", S), ("dataownerisoperator", B)],
                 ["organizationalunitcode", "schedulecode", "scheduletypecode", "lineplanningnumber",
                  "journeynumber", "stoporder"]),
    "schedpujo": ([("organizationalunitcode", S), ("schedulecode", S), ("scheduletypecode", S),
                   ("lineplanningnumber", S), ("journeynumber", I), ("timedemandgroupcode", S),
                   ("journeypatterncode", S), ("departuretime", S), ("wheelchairaccessible", S),
                   ("dataownerisoperator", B)],
                  ["organizationalunitcode", "schedulecode", "scheduletypecode", "lineplanningnumber",
                   "journeynumber"]),
}

# load order of the feed files (tables missing from a delivery are skipped)
IMPORT_ORDER = ["dest", "line", "conarea", "confinrel", "point", "usrstar", "usrstop", "tili", "link", "pool", "jopa",
                "jopatili", "orun", "orunorun", "specday", "pegr", "excopday", "pegrval", "tive", "timdemgrp",
                "timdemrnt", "pujo", "schedvers", "pujopass", "schedpujo", "operday"]

# dialect -> {table: columns the operator does not deliver}; type overrides
_NO_TRANSPORT = {"link": ["transporttype"], "pool": ["transporttype"]}
DIALECTS: dict[str, dict[str, list[str]]] = {
    "standard": {},
    "arriva": _NO_TRANSPORT,
    "syntus": _NO_TRANSPORT,
    "qbuzz": _NO_TRANSPORT,
    "ebs": {"jopatili": ["productformulatype"]},
    "veolia": {**_NO_TRANSPORT, "line": ["transporttype"], "dest": ["relevantdestnamedetail"],
               "usrstop": ["userstoptype"], "jopatili": ["productformulatype"],
               "pujopass": ["wheelchairaccessible", "dataownerisoperator"]},
}
TYPE_OVERRIDES: dict[str, dict[str, dict[str, str]]] = {"veolia": {"line": {"linevetagnumber": S}}}


def columns(table: str, dialect: str = "standard") -> list[tuple[str, str]]:
    """(name, type) of the columns present in the file, in file order."""
    cols, _ = KV1_TABLES[table]
    dropped = set(DIALECTS.get(dialect, {}).get(table, []))
    over = TYPE_OVERRIDES.get(dialect, {}).get(table, {})
    return [(n, over.get(n, t)) for n, t in HEAD + cols if n not in dropped]


def full_columns(table: str) -> list[tuple[str, str]]:
    cols, _ = KV1_TABLES[table]
    return HEAD + cols


def keys(table: str) -> list[str]:
    return ["version", "dataownercode"] + KV1_TABLES[table][1]


_TYPES = {"string": T.StringType, "int": T.IntegerType, "long": T.LongType, "boolean": T.BooleanType,
          "date": T.DateType, "timestamp": T.TimestampType}


def struct(table: str, dialect: str = "standard") -> T.StructType:
    return T.StructType([T.StructField(n, _TYPES[t](), True) for n, t in columns(table, dialect)])
