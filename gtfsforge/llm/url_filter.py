"""URL verdicts: host and path rules, and a Bloom filter cascade over listed domains.

The cascade gives exact membership in a list without joining it to the urls.  Its keys
are domains; the universe is every domain that occurs, that is, the hosts of all urls with their
parent domains, and the list.  Level 1 is a Bloom filter of the listed keys; level 2 one of those keys
of the universe that are not listed but pass level 1; level 3 one of the
listed keys that pass level 2; and so on, until a level lets no wrong key pass.  For a key
of the universe the first level that it does not pass then tells exactly whether it is
listed: an odd level says no, an even one yes; a key that passes all levels belongs to
what the last one encodes.  A url asks for those of its host and parent domains that have as many
labels as some listed domain.

Everything is DataFrame and SQL functions: a level is an aggregate that sets bits
(``bit_or`` by 64-bit word), written as arrays of longs, and a lookup reads bits of
them through a scalar subquery.  Keys are dealt to shards by their hash, as many as it takes for the
listed keys of a shard to fit ``max_bits``, and every shard has filters of its own; ``GROUP`` shards
are sent to the tasks at a time (32 MB a level at most), so a list of any length is
looked up the same way, in as many passes as it needs.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .frames import stored

#: Bits per encoded key, hash functions, bits of a shard's filter on average (512 KB), and shards looked up at a time.
BITS_PER_KEY = 10
HASHES = 5
MAX_BITS = 1 << 22
GROUP = 64
#: A name of more labels is no domain.
LABELS = 127


class Rule(NamedTuple):
    """Fits a host and its subdomains where the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


#: The rules of the registered query.
RULES = (Rule("allow", "org", "/"), Rule("block", "example.org", "/es/"), Rule("block", "example.org", "/en/1"),
         Rule("allow", "com", "/fr/"), Rule("block", "com", "/de/"))
#: The registered query lists every domain of the corpus that is named so, under whatever parents.
NAMES = ("adult-x", "ads-track", "casino-win", "cheap-pills", "free-bets", "spam-farm")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    rest = _rest(url)
    return F.translate(F.regexp_extract(rest, r"\A([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """From the host's end up to ``?``, ``#`` or the end; else empty."""
    return F.regexp_extract(_rest(url), r"\A[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))


def suffixes(host: Column) -> Column:
    """The host and its parent domains: a.b.c -> [a.b.c, b.c, c]; empty host: none."""
    labels = F.split(host, r"\.")
    n = F.size(labels)
    return F.when(host == "", F.array().cast("array<string>")).otherwise(
        F.transform(F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(labels, i, n), ".")))


def labels(domain: Column) -> Column:
    """The number of a domain's labels."""
    return F.length(domain) - F.length(F.replace(domain, F.lit("."), F.lit(""))) + 1


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """(name, verdict) of the longest rule that fits, or nulls."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: len(r.name)):
        fits = ((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path))
        name, verdict = F.when(fits, F.lit(r.name)).otherwise(name), F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return name, verdict


def domains(pages: DataFrame, url: str = "url") -> DataFrame:
    """(key): the hosts of all urls and their parent domains."""
    hosts = pages.select(host_of(F.col(f"`{url}`")).alias("host")).where("host != ''").distinct()
    return hosts.select(F.explode(suffixes(F.col("host"))).alias("key")).distinct()


def named(keys: DataFrame, names: Sequence[str] = NAMES) -> DataFrame:
    """The domains that bear one of the names themselves (not only below them)."""
    return keys.where(F.substring_index("key", ".", 1).isin(*names))


def _bit(key: Column, level: int, i: int, bits: int) -> Column:
    """The i-th bit position of a key in a level."""
    return F.pmod(F.xxhash64(F.lit(level * HASHES + i), key), F.lit(bits).cast("long"))


class Cascade:
    """Levels over a universe (``key``, ``listed``; keys distinct)."""

    def __init__(self, universe: DataFrame, max_bits: int = MAX_BITS, group: int = GROUP):
        self.group = group
        self.levels: list[tuple[DataFrame, int]] = []  # (shard, words), bits of each shard
        encoded, other = universe.where("listed").select("key"), universe.where(~F.col("listed")).select("key")
        n = encoded.count()
        self.shards = max(1, -(-n * BITS_PER_KEY // max_bits))
        while n:
            level = len(self.levels)
            most = encoded.groupBy(self._shard(F.col("key")).alias("s")).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).head()[0]
            bits = -(-most * BITS_PER_KEY // 64) * 64
            self.levels.append((stored(self._filter(encoded, level, bits), "bloom"), bits))
            wrong = None
            for g in self.groups():
                part = other.where(self._of_group(F.col("key"), g) & self._passes(F.col("key"), self._words(level, g).scalar(), level, g))
                wrong = part if wrong is None else wrong.unionAll(part)
            wrong = stored(wrong, "passed")
            encoded, other = wrong, encoded
            n = encoded.count()

    def groups(self) -> range:
        return range(-(-self.shards // self.group))

    def _shard(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(F.lit(-1), key), F.lit(self.shards).cast("long"))

    def _of_group(self, key: Column, g: int) -> Column:
        return F.floor(self._shard(key) / self.group) == g

    def _filter(self, keys: DataFrame, level: int, bits: int) -> DataFrame:
        """(shard, words) of every shard."""
        spots = keys.select(self._shard(F.col("key")).alias("s"), F.explode(F.array(*[_bit(F.col("key"), level, i, bits) for i in range(HASHES)])).alias("p")) \
            .select("s", F.shiftright("p", 6).alias("w"), F.expr("shiftleft(1L, CAST(p & 63 AS INT))").alias("x"))
        blank = keys.sparkSession.range(self.shards).select(F.col("id").alias("s"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(bits // 64 - 1).cast("long"))).alias("w"), F.lit(0).cast("long").alias("x"))
        words = spots.unionAll(blank).groupBy("s", "w").agg(F.bit_or("x").alias("x"))
        return words.groupBy(F.col("s").alias("shard")).agg(F.transform(F.array_sort(F.collect_list(F.struct("w", "x"))), lambda s: s.x).alias("words"))

    def _words(self, level: int, g: int) -> DataFrame:
        """One row: the words of a group's shards, in their order."""
        table = self.levels[level][0].where(F.floor(F.col("shard") / self.group) == g)
        return table.agg(F.transform(F.array_sort(F.collect_list(F.struct("shard", "words"))), lambda s: s.words).alias("words"))

    def _passes(self, key: Column, words: Column, level: int, g: int) -> Column:
        own = F.get(words, (self._shard(key) - g * self.group).cast("int"))
        ok = F.lit(True)
        for i in range(HASHES):
            p = _bit(key, level, i, self.levels[level][1])
            ok = ok & (F.getbit(F.get(own, F.shiftright(p, 6).cast("int")), p.bitwiseAND(F.lit(63)).cast("int")) == 1)
        return ok

    def tables(self, g: int = 0) -> list[Column]:
        """The levels of a group of shards, to be looked up by :meth:`listed`."""
        return [self._words(k, g).scalar() for k in range(len(self.levels))]

    def listed(self, key: Column, tables: Sequence[Column], g: int = 0) -> Column:
        """Whether a key of the universe is listed; false for keys of other groups."""
        answer = F.lit(len(self.levels) % 2 == 1)
        for k in range(len(self.levels) - 1, -1, -1):
            answer = F.when(self._passes(key, tables[k], k, g), answer).otherwise(F.lit(k % 2 == 1))
        answer = key.isNotNull() & answer
        return answer if self.shards <= self.group else F.when(self._of_group(key, g), answer).otherwise(F.lit(False))


def verdicts(pages: DataFrame, listed: DataFrame, id_col: str = "page_id", url: str = "url", rules: Sequence[Rule] = RULES,
             max_bits: int = MAX_BITS, group: int = GROUP) -> DataFrame:
    """(id, host, path, rule, verdict) per input row.

    ``listed``: one column of blocked domains (a domain blocks its subdomains; nulls, names of over
    127 labels and the case of letters don't matter).  The longest rule that fits decides; without one a url is
    blocked if its host or a parent domain is listed, else allowed.  Defined results: a
    null url, or one without ``://``, has an empty host and path, no rule, and is allowed; repeated
    rows each get a row; an empty table stays empty; other columns are ignored.
    """
    base = pages.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{url}`").alias("u")).select("id", host_of(F.col("u")).alias("host"), path_of(F.col("u")).alias("path"))
    block = listed.select(F.lower(F.col(f"`{listed.columns[0]}`")).alias("key"), F.lit(True).alias("listed")).where(labels(F.col("key")) <= LABELS)
    # a host asks only for its suffixes of as many labels as listed domains have
    lengths = sorted(r[0] for r in block.select(labels(F.col("key"))).distinct().collect())
    asked = [F.when(labels(F.col("host")) >= n, F.substring_index("host", ".", -n)) for n in lengths]
    hosts = base.select("host").where("host != ''").distinct()
    keys = hosts.select(F.explode(F.array(*asked, F.lit(None).cast("string"))).alias("key")).where("key is not null").distinct()
    keys = keys.withColumn("listed", F.lit(False)).unionByName(block)
    cascade = Cascade(stored(keys.groupBy("key").agg(F.bool_or("listed").alias("listed")), "universe"), max_bits, group)
    judged = base.withColumn("bad", F.lit(False))
    for g in cascade.groups():
        tables = cascade.tables(g)
        judged = judged if not g else stored(judged, "judged")
        hit = F.lit(False)
        for key in asked:
            hit = hit | cascade.listed(key, tables, g)
        judged = judged.withColumn("bad", F.col("bad") | hit)
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    return judged.select(F.col("id").alias(id_col), "host", "path", name.alias("rule"),
                         F.coalesce(verdict, F.when(F.col("bad"), "block").otherwise("allow")).alias("verdict"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return verdicts(pages, named(domains(pages)))


ORACLE = r"""
WITH u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
hp AS (SELECT page_id, translate(regexp_extract(r, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
              regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
rules(verdict, h, p) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
                                ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
hit AS (SELECT page_id, arg_max(h || p, length(h || p)) AS rule, arg_max(verdict, length(h || p)) AS verdict
        FROM hp JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id)
SELECT hp.page_id, host, path, rule, coalesce(verdict, CASE WHEN list_has_any(string_split(host, '.'),
  ['adult-x', 'ads-track', 'casino-win', 'cheap-pills', 'free-bets', 'spam-farm']) THEN 'block' ELSE 'allow' END) AS verdict
FROM hp LEFT JOIN hit USING (page_id)
"""
