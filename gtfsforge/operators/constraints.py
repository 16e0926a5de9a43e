"""Keys, references and required columns of a set of tables as a graph (B-2, B-3, B-4, B-6).

A :class:`Constraints` graph holds, for any number of tables, their key, the columns that may not
be NULL and the references between them.  :func:`check` is one plan that counts the
violations of every constraint; :func:`delete` follows deletions along the
references, parents first, however many steps they take.

Nothing is enforced while loading: a load never fails half way, and a check is an ordinary job of
pre-aggregated counts and anti-joins on distinct keys.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources import schemas


@dataclass(frozen=True)
class Reference:
    """``child`` (columns) names a row of ``parent`` (parent_columns); a NULL part names none."""

    child: str
    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]
    cascade: bool = False

    def __str__(self) -> str:
        return f"{self.child}({', '.join(self.columns)}) -> {self.parent}"


@dataclass
class Constraints:
    keys: dict[str, tuple[str, ...]] = field(default_factory=dict)
    references: list[Reference] = field(default_factory=list)
    required: dict[str, tuple[str, ...]] = field(default_factory=dict)

    def of(self, tables: Mapping[str, DataFrame]) -> Constraints:
        """What can be told about these tables: constraints whose tables and columns are there."""
        have = {t: set(df.columns) for t, df in tables.items()}
        return Constraints(
            {t: k for t, k in self.keys.items() if t in have and have[t].issuperset(k)},
            [r for r in self.references if have.get(r.child, set()).issuperset(r.columns) and have.get(r.parent, set()).issuperset(r.parent_columns)],
            {t: tuple(c for c in cols if c in have[t]) for t, cols in self.required.items() if t in have})

    def parents_first(self, tables: Iterable[str]) -> list[str]:
        """The tables in an order in which every reference points backwards."""
        left, out = list(tables), []
        while left:
            free = [t for t in left if not any(r.child == t and r.parent in left and r.parent != t for r in self.references)]
            if not free:
                raise ValueError(f"the references of {', '.join(left)} form a circle")
            out += free
            left = [t for t in left if t not in free]
        return out


def _graph(keys: Mapping[str, Sequence[str]], references: Iterable[tuple], required: Mapping[str, Sequence[str]] = {}) -> Constraints:
    refs = []
    for child, columns, parent, *how in references:
        own = tuple(columns.split())
        theirs = tuple(how[0].split()) if how and isinstance(how[0], str) else own
        refs.append(Reference(child, own, parent, theirs, bool(how) and how[-1] is True))
    return Constraints({t: tuple(k) for t, k in keys.items()}, refs, {t: tuple(c) for t, c in required.items()})


_V = "version dataownercode "
_SCHEDULE = _V + "organizationalunitcode schedulecode scheduletypecode"
_PATTERN = _V + "lineplanningnumber journeypatterncode"
_STOPS = _V + "userstopcodebegin userstopcodeend"

# ---- fixed values: references of the KV1, rail and metro tables, and columns that may be NULL ----
KV1_REFERENCES = [
    ("confinrel", _V + "concessionareacode", "conarea"),
    ("tili", _V + "userstopcodeend", "usrstop", _V + "userstopcode"),
    ("link", _STOPS, "tili"),
    ("pool", _STOPS + " linkvalidfrom transporttype", "link", _STOPS + " validfrom transporttype"),
    ("pool", "version pointdataownercode pointcode", "point", _V + "pointcode"),
    ("jopa", _V + "lineplanningnumber", "line"),
    ("jopatili", _V + "confinrelcode", "confinrel"),
    ("jopatili", _V + "destcode", "dest"),
    ("jopatili", _PATTERN, "jopa"),
    ("jopatili", _STOPS, "tili"),
    ("orunorun", _V + "organizationalunitcodechild", "orun", _V + "organizationalunitcode"),
    ("excopday", _V + "periodgroupcode", "pegr"),
    ("excopday", _V + "specificdaycode", "specday"),
    ("pegrval", _V + "organizationalunitcode", "orun"),
    ("tive", _V + "organizationalunitcode", "orun"),
    ("tive", _V + "periodgroupcode", "pegr"),
    ("tive", _V + "specificdaycode", "specday"),
    ("timdemgrp", _PATTERN, "jopa"),
    ("timdemrnt", _PATTERN + " timedemandgroupcode", "timdemgrp"),
    ("timdemrnt", _PATTERN + " timinglinkorder", "jopatili"),
    ("pujo", _PATTERN + " timedemandgroupcode", "timdemgrp"),
    ("pujo", _V + "organizationalunitcode timetableversioncode periodgroupcode specificdaycode", "tive"),
    ("schedvers", _V + "organizationalunitcode", "orun"),
    ("operday", _SCHEDULE, "schedvers"),
    ("pujopass", _SCHEDULE, "schedvers"),
    ("pujopass", _V + "userstopcode", "usrstop"),
    ("pujopass", _PATTERN, "jopa"),
    ("schedpujo", _SCHEDULE, "schedvers"),
    ("schedpujo", _PATTERN + " timedemandgroupcode", "timdemgrp"),
    ("schedpujo", _PATTERN, "jopa"),
]
KV1_NULLABLE = {
    "dest": "destnamedetail relevantdestnamedetail", "line": "description transporttype", "confinrel": "financercode",
    "usrstar": "roadsideeqdataownercode roadsideequnitnumber description",
    "usrstop": "timingpointcode deprecated userstopareacode stopsidecode roadsideeqdataownercode roadsideequnitnumber stopsidelength description userstoptype",
    "point": "locationz description", "tili": "minimaldrivetime description", "link": "description transporttype",
    "pool": "segmentspeed localpointspeed description transporttype", "jopa": "description",
    "jopatili": "deprecated displaypublicline productformulatype", "orun": "description", "specday": "description", "pegr": "description",
    "excopday": "periodgroupcode description", "tive": "validthru description", "timdemrnt": "expecteddelay layovertime minimumstoptime",
    "schedvers": "validthru description", "operday": "description",
    "pujopass": "targetarrivaltime targetdeparturetime wheelchairaccessible", "schedpujo": "departuretime wheelchairaccessible",
}
IFF_KEYS = {
    "country": ["code"], "company": ["company"], "timezone": ["tznumber"], "station": ["shortname"], "trnsattr": ["code"],
    "trnsaqst": ["code", "transattr"], "trnsmode": ["code"], "connmode": ["code"], "contconn": ["fromstation", "tostation", "connectionmode"],
    "stop": ["serviceid", "idx"], "platform": ["serviceid", "idx"],
}
IFF_REFERENCES = [
    ("delivery", "company", "company"), ("station", "country", "country", "code"), ("station", "timezone", "timezone", "tznumber"),
    ("trnsaqst", "transattr", "trnsattr", "code"), ("contconn", "fromstation", "station", "shortname"), ("contconn", "tostation", "station", "shortname"),
    ("contconn", "connectionmode", "connmode", "code"), ("service", "companynumber", "company", "company"), ("transport", "transmode", "trnsmode", "code"),
    ("attribute", "code", "trnsattr"), ("stop", "station", "station", "shortname"), ("platform", "station", "station", "shortname"),
    ("platform", "serviceid idx", "stop"), ("changes", "station", "station", "shortname"),
]
IFF_REQUIRED = {
    "country": ["inland", "name"], "company": ["code", "name"], "timezone": ["firstday", "lastday"], "trnsattr": ["processingcode"],
    "trnsaqst": ["question"], "connmode": ["connectiontype"], "contconn": ["connectiontime", "connectionmode"], "service": ["serviceid"],
    "validity": ["serviceid"], "transport": ["serviceid"], "attribute": ["serviceid"], "changes": ["fromservice", "toservice"],
}
_JOURNEY = ["vervoerdercode", "lijnsysteemnr", "ritnummer", "voetnoot"]
PAS_KEYS = {"stops": ["halteid"], "voetnoot": ["voetnoot", "datum"], "pujo": _JOURNEY, "pujopass": [*_JOURNEY, "stopsequentie"]}
PAS_REFERENCES = [("pujopass", "halteid", "stops", True)]
PAS_REQUIRED = {"stops": ["x", "y"], "pujo": ["modaliteit", "richting"], "pujopass": ["richting", "halteid"]}
# ---- end of fixed values ----


def kv1_constraints() -> Constraints:
    """KV1: keys, required columns, references; every table hangs on the ledger (``version``), whose deletions cascade."""
    keys = {t: schemas.keys(t) for t in schemas.KV1_TABLES} | {"version": ["version", "dataownercode"]}
    required = {t: [n for n, _ in schemas.full_columns(t) if n not in KV1_NULLABLE.get(t, "").split() and n not in schemas.keys(t)] for t in schemas.KV1_TABLES}
    required["version"] = ["validfrom", "filename", "dataownerversion"]
    return _graph(keys, [*KV1_REFERENCES, *[(t, _V.strip(), "version", True) for t in schemas.KV1_TABLES]], required)


def iff_constraints() -> Constraints:
    return _graph(IFF_KEYS, IFF_REFERENCES, IFF_REQUIRED)


def pas_constraints() -> Constraints:
    """Metro: passes of a deleted stop go with it."""
    return _graph(PAS_KEYS, PAS_REFERENCES, PAS_REQUIRED)


def _matches(left: Sequence[str], right: Sequence[str]) -> Column:
    out = F.lit(True)
    for a, b in zip(left, right):
        out = out & (F.col(a) == F.col(b))
    return out


def _named_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    for c in columns:
        df = df.filter(F.col(c).isNotNull())
    return df


def check(tables: Mapping[str, DataFrame], graph: Constraints) -> DataFrame:
    """(kind, constraint, violations) for every constraint that the tables can be held to, also with 0.

    ``key``: key values that occur more than once; ``required``: rows with a NULL in the column
    (keys included); ``reference``: rows that name no row of the parent."""
    g = graph.of(tables)
    parts: list[DataFrame] = []

    def counted(kind: str, name: str, rows: DataFrame, n: Column) -> None:
        parts.append(rows.agg(n.alias("violations")).select(F.lit(kind).alias("kind"), F.lit(name).alias("constraint"), F.coalesce("violations", F.lit(0)).cast("long").alias("violations")))

    for t, df in tables.items():
        columns = list(dict.fromkeys([*g.keys.get(t, ()), *g.required.get(t, ())]))
        if columns:  # one scan of the table for all of its columns
            nulls = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(columns)])
            rows = F.inline(F.array(*[F.struct(F.lit("required").alias("kind"), F.lit(f"{t}.{c}").alias("constraint"), F.col(f"n{i}").alias("violations")) for i, c in enumerate(columns)]))
            parts.append(nulls.select(rows))
        if t in g.keys:
            again = df.groupBy(*g.keys[t]).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
            counted("key", f"{t}({', '.join(g.keys[t])})", again, F.count(F.lit(1)))
    for r in g.references:
        named = _named_rows(tables[r.child], r.columns).groupBy(*r.columns).agg(F.count(F.lit(1)).alias("n"))
        there = tables[r.parent].select(*[F.col(c).alias(f"p{i}") for i, c in enumerate(r.parent_columns)]).distinct()
        missing = named.join(there, _matches(r.columns, [f"p{i}" for i in range(len(r.columns))]), "left_anti")
        counted("reference", str(r), missing, F.sum("n"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def delete(tables: Mapping[str, DataFrame], graph: Constraints, dead: Mapping[str, DataFrame], follow_all: bool = False) -> dict[str, DataFrame]:
    """The tables after deletions, with the deletions that follow from them.

    ``dead``: per table the key columns of rows to delete.  A row goes if it is listed, or names a row
    that goes, along references that cascade (``follow_all``: along all).  Rows
    that name nothing, because of a NULL or a parent that never was, stay.  Each table whose rows can be
    named by others is written once with its verdicts, so that a chain of any length reads
    every table once."""
    g = graph.of(tables)
    verdict: dict[str, DataFrame] = {}
    for t in g.parents_first(tables):
        df = tables[t]
        doomed = [(r.columns, verdict[r.parent].filter("__gone").select(*r.parent_columns), r.parent_columns)
                  for r in g.references if r.child == t and r.parent in verdict and (r.cascade or follow_all)]
        if t in dead:
            doomed.append((tuple(dead[t].columns), dead[t], tuple(dead[t].columns)))
        if not doomed:
            continue
        gone = F.lit(False)
        for k, (own, rows, theirs) in enumerate(doomed):
            flag, names = f"__f{k}", [f"__p{k}_{i}" for i in range(len(own))]
            hit = rows.select(*[F.col(c).alias(n) for c, n in zip(theirs, names)]).distinct().withColumn(flag, F.lit(True))
            df = df.join(hit, _matches(own, names), "left").drop(*names)
            gone = gone | F.coalesce(F.col(flag), F.lit(False))
        df = df.select(*tables[t].columns, gone.alias("__gone"))
        if any(r.parent == t and (r.cascade or follow_all) for r in g.references):
            path = scratch_path(df.sparkSession, f"deleted/{t}-{uuid.uuid4().hex}")
            df.write.parquet(path)
            df = df.sparkSession.read.parquet(path)
        verdict[t] = df
    return {t: verdict[t].filter("not __gone").drop("__gone") if t in verdict else df for t, df in tables.items()}
