"""URL filters by a Bloom filter cascade (native).

A cascade answers "is this key listed?" exactly, for every key of a known
universe, without a join: level 0 is a Bloom filter of the listed keys,
level 1 one of the universe keys that level 0 wrongly accepts, level 2 one of
the listed keys that level 1 accepts, and so on until no key is wrong.  A key
is followed down the levels; the first level that rejects it decides.

The universe is complete over the corpus: every (host suffix + path prefix)
key that any page can ask for.  Filters are built by Spark aggregations and
hold ``BITS_PER_KEY`` bits for a key of their level, so their size is known
before they are made; one above ``MAX_FILTER_BITS`` raises instead of being
shipped to the executors.

Defined results: a null URL or one without ``://`` has an empty host and path,
no rule and verdict allow; repeated pages each get a row; null ids stay null;
an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.base import pick, register, stored, table

HASHES = 4
BITS_PER_KEY = 12
MAX_FILTER_BITS = 1 << 27          # 16 MB of literal per level
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: (host, path, verdict); fixed values of the query's contract.
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
#: Hosts with one of these terms in a label are listed for blocking.
BLOCKED_TERMS = ("casino", "poker", "viagra", "xxx", "porn")


@dataclass(frozen=True)
class Level:
    bits: int
    words: np.ndarray               # int64, bits / 64 of them


class Cascade:
    """Levels of filters; ``contains(key)`` is an exact test as a Spark expression."""

    def __init__(self, levels: list[Level]):
        self.levels = levels

    def contains(self, key: Column) -> Column:
        answer = F.lit(len(self.levels) % 2 == 1)
        for n in range(len(self.levels) - 1, -1, -1):
            answer = F.when(_accepts(self.levels[n], n, key), answer).otherwise(F.lit(n % 2 == 1))
        return answer if self.levels else F.lit(False)


def _positions(key: Column, level: int, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(level), F.lit(i), key), F.lit(bits)) for i in range(HASHES)]


def _accepts(level: Level, n: int, key: Column) -> Column:
    filter_words = F.lit(level.words)
    hit = F.lit(True)
    for p in _positions(key, n, level.bits):
        word = F.element_at(filter_words, (F.shiftright(p, 6) + 1).cast("int"))
        hit = hit & (F.getbit(word, F.pmod(p, F.lit(64)).cast("int")) == 1)
    return hit


def _bits(n: int, count: int) -> int:
    bits = 64
    while bits < count * BITS_PER_KEY:
        bits *= 2
    if bits > MAX_FILTER_BITS:
        raise ValueError(f"cascade level {n}: {count} keys need {bits} bits, more than {MAX_FILTER_BITS}")
    return bits


def _build_levels(keys: DataFrame, n: int, counts: dict[str, int]) -> dict[str, Level]:
    """Level ``n`` of every list in ``counts``, by one aggregation of ``keys`` (list, key)."""
    sizes = {name: _bits(n, count) for name, count in counts.items()}
    bits = F.coalesce(*[F.when(F.col("list") == name, F.lit(b)) for name, b in sizes.items()])
    found = (keys.select("list", F.explode(F.array(*_positions(F.col("key"), n, bits))).alias("p"))
             .groupBy("list", F.shiftright("p", 6).alias("w"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(pmod(p, 64) as int))")).alias("v"))).toArrow()
    # at most bits / 64 rows of a list, and all in one job: a job for each of its partitions would take longer than the work
    lists, at, words = (found[c].to_numpy() for c in ("list", "w", "v"))
    out = {}
    for name, b in sizes.items():
        out[name] = Level(b, np.zeros(b // 64, dtype=np.int64))
        out[name].words[at[lists == name]] = words[lists == name]
    return out


def build_cascades(lists: dict[str, tuple[DataFrame, DataFrame]], max_levels: int = 40) -> dict[str, Cascade]:
    """The cascade of each (listed, universe), tables with a column key; a level of all of them takes two jobs.
    Exact for every key of either table; null keys are ignored."""
    sides = [df.select(F.lit(name).alias("list"), "key", F.lit(listed).alias("listed"))
             for name, (mine, universe) in lists.items() for listed, df in ((False, universe), (True, mine))]
    marked = (functools.reduce(DataFrame.unionByName, sides).where(F.col("key").isNotNull())
              .groupBy("list", "key").agg(F.max("listed").alias("listed")))
    marked = stored(marked, "url-universe")
    levels: dict[str, list[Level]] = {name: [] for name in lists}
    live = list(lists)
    for n in range(max_levels):
        inside = n % 2 == 0                     # even levels hold listed keys

        def asked(name):
            """The keys of the level: those of its side that no level of the other side has rejected."""
            before = [_accepts(levels[name][k], k, F.col("key")) for k in range(1 - n % 2, n, 2)]
            return functools.reduce(Column.__and__, before, (F.col("list") == name) & (F.col("listed") == inside))

        row = marked.agg(*[F.count_if(asked(name)) for name in live]).first()
        counts = {name: count for name, count in zip(live, row) if count}
        live = list(counts)
        if not live:
            return {name: Cascade(found) for name, found in levels.items()}
        keys = marked.where(functools.reduce(Column.__or__, map(asked, live)))
        for name, level in _build_levels(keys, n, counts).items():
            levels[name].append(level)
    raise ValueError(f"no exact cascade within {max_levels} levels")


def build_cascade(listed: DataFrame, universe: DataFrame, max_levels: int = 40) -> Cascade:
    """The cascade of ``listed`` (column key) over ``universe`` (column key)."""
    return build_cascades({"": (listed, universe)}, max_levels)[""]


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path) as the contract defines them."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit("")), F.coalesce(path, F.lit(""))


def host_suffixes(host: Column) -> Column:
    """The host and the hosts above it: a.b.c, b.c, c."""
    parts = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(parts)),
                       lambda i: F.concat_ws(".", F.slice(parts, i, F.size(parts))))


def candidate_keys(host: Column, path: Column, lengths: list[int]) -> Column:
    """Every rule key a page can match: host suffix + path prefix of a length that some rule has."""
    prefixes = F.filter(F.array(*[F.substring(path, 1, n) for n in lengths]), lambda p: p != "")
    prefixes = F.array_distinct(prefixes)
    return F.flatten(F.transform(host_suffixes(host), lambda s: F.transform(prefixes, lambda p: F.concat(s, p))))


def judge_urls(pages: DataFrame, rules=RULES, blocked_hosts: DataFrame | None = None,
               id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict for every page.

    ``rules`` are few and given by the caller; ``blocked_hosts`` (column key) is
    a table of any size.  The longest rule that fits decides; without one a
    page is blocked if its host, or one above it, is a listed host.
    """
    src = pick(pages, page_id=id_col, url=url_col)
    spark = src.sparkSession
    host, path = split_url(F.col("url"))
    rows = src.select("page_id", host.alias("host"), path.alias("path"))
    lengths = sorted({len(p) for _, p, _ in rules})
    keyed = rows.withColumn("keys", candidate_keys(F.col("host"), F.col("path"), lengths))
    universe = keyed.select("host", "path").distinct()
    universe = universe.select(F.explode(candidate_keys(F.col("host"), F.col("path"), lengths)).alias("key"))
    hosts = rows.select("host").distinct().select(F.explode(host_suffixes(F.col("host"))).alias("key"))
    as_keys = lambda v: spark.createDataFrame([(h + p,) for h, p, w in rules if w in v], "key string")
    lists = {"rules": (as_keys(("allow", "block")), universe),
             "block": (as_keys(("block",)), as_keys(("allow",)))}        # asked for the rules that fit, and nothing else
    if blocked_hosts is not None:
        lists["hosts"] = blocked_hosts, hosts
    built = build_cascades(lists)
    in_rules, in_block, in_hosts = (built.get(name, Cascade([])) for name in ("rules", "block", "hosts"))
    longest = lambda a, x: F.when(F.length(x) > F.length(a), x).otherwise(a)
    best = F.reduce(F.filter("keys", in_rules.contains), F.lit(""), longest)
    out = keyed.withColumn("rule", F.nullif(best, F.lit("")))
    listed = F.exists(host_suffixes(F.col("host")), in_hosts.contains)
    blocked = F.when(F.col("rule").isNotNull(), in_block.contains(F.col("rule"))).otherwise(listed)
    return out.select("page_id", "host", "path", "rule",
                      F.when(blocked, F.lit("block")).otherwise(F.lit("allow")).alias("verdict"))


def term_hosts(pages: DataFrame, terms=BLOCKED_TERMS, url_col: str = "url") -> DataFrame:
    """The corpus's hosts that carry a blocked term, as list keys."""
    host, _ = split_url(pages[url_col])
    return pages.select(host.alias("key")).distinct().where(F.col("key").rlike("|".join(terms)))


_PARTS = """
SELECT page_id, coalesce(translate(host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
       coalesce(regexp_extract(substr(rest, length(host) + 1), '^[^?#]*'), '') AS path
FROM (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS host
      FROM (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
            FROM pages))
"""
_FIT = " ".join(
    f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{h}{p}'"
    for h, p, _ in sorted(RULES, key=lambda r: -len(r[0] + r[1])))
ORACLE_SQL = f"""
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ({", ".join(f"'{h}{p}'" for h, p, v in RULES if v == "block")}) THEN 'block'
            WHEN rule IS NOT NULL THEN 'allow'
            WHEN regexp_matches(host, '{"|".join(BLOCKED_TERMS)}') THEN 'block' ELSE 'allow' END AS verdict
FROM (SELECT *, CASE {_FIT} END AS rule FROM ({_PARTS}))
"""


@register("op7_url_filter", ORACLE_SQL)
def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return judge_urls(pages, blocked_hosts=term_hosts(pages))
