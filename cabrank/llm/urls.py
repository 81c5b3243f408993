"""Rules for URLs, looked up in a cascade of Bloom filters instead of a join.

A rule is a host with a path, such as ``example.com/en/``. It fits a URL whose
host is that host or a subdomain of it and whose path starts with that path. The
candidate keys of a URL are the ends of its host, each with the beginnings of its
path that have a length some rule's path has.

The cascade answers exactly whether a key is listed, for every key of a corpus:
the first filter encodes the listed keys, the second the corpus keys that pass
the first without being listed, the third the listed keys that pass the second,
and so on until none is wrong. Its first filter is as fine as the corpus calls
for, so that about as many keys are wrong as are listed; all levels together take
some 1.44 * log2(corpus keys / listed keys) + 3 bits for a listed key. Filters
are words of bits held as literals, of at most ``MOST_BYTES`` in all, which is
worked out before any is built; longer lists are looked up by a shuffled join.

NULL URLs and those without ``://`` have an empty host and path and fit no rule.
Of several rules that fit the longest wins, then the one with the longer host,
then block. NULL rules are left out. Rows with equal ids each get a row.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cabrank.llm.common import staged

MOST_BYTES = 8 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DEFAULT = "allow"


@dataclass(frozen=True)
class Level:
    """One Bloom filter: its words of 64 bits, its size in bits, hashes, and the number that seeds them."""

    words: list[int]
    bits: int
    hashes: int
    number: int


def parsed(pages: DataFrame, url: str = "url") -> DataFrame:
    """The rows with host and path of their URL."""
    at = F.instr(F.col(url), "://")
    after = F.expr(f"substring(`{url}`, instr(`{url}`, '://') + 3)")
    host = F.when(at > 0, F.regexp_extract(after, "^[^/?#]*", 0)).otherwise("")
    path = F.when(at > 0, F.regexp_extract(after, "^[^/?#]*([^?#]*)", 1)).otherwise("")
    return pages.withColumns({"host": F.translate(host, UPPER, LOWER), "path": path})


def rule_table(rules: DataFrame) -> DataFrame:
    """Rules (``rule``, ``action``) with the parts of their text, one row each; block wins over allow."""
    text = F.translate(F.substring_index("rule", "/", 1), UPPER, LOWER)
    path = F.expr("substring(rule, length(substring_index(rule, '/', 1)) + 1)")
    named = rules.filter("rule is not null and action in ('allow', 'block')")
    named = named.select(F.concat(text, path).alias("key"), "action", text.alias("host"), F.length(path).alias("reach"))
    return named.groupBy("key", "host", "reach").agg(F.max("action").alias("action"))


def keys_of(labels: int, reaches: list[int]) -> Column:
    """The candidate keys of a URL: up to so many labels of the host, with each beginning of the path."""
    ends = f"""transform(sequence(1, least({labels}, size(split(host, '[.]')))),
        n -> array_join(slice(split(host, '[.]'), -n, n), '.'))"""
    starts = ", ".join(f"case when length(path) >= {n} then substring(path, 1, {n}) end" for n in reaches)
    pairs = f"""flatten(transform({ends}, h -> transform(filter(array({starts}), p -> p is not null),
        p -> named_struct('key', concat(h, p), 'host', h))))"""
    none = "cast(array() as array<struct<key: string, host: string>>)"
    return F.expr(f"case when host = '' then {none} else {pairs} end" if reaches else none)


def positions(key: Column, level: Level) -> list[Column]:
    seeds = [F.lit(level.number * 64 + i) for i in range(level.hashes)]
    return [F.pmod(F.xxhash64(key, seed), F.lit(level.bits)) for seed in seeds]


def contains(key: Column, level: Level) -> Column:
    words = F.from_json(F.lit(json.dumps(level.words)), "array<bigint>")
    bit = [F.getbit(F.get(words, F.shiftright(p, 6).cast("int")), F.pmod(p, F.lit(64)).cast("int")) == 1 for p in positions(key, level)]
    out = bit[0]
    for more in bit[1:]:
        out = out & more
    return out


def listed(key: Column, levels: list[Level]) -> Column:
    """Whether a key of the corpus is listed: it is, if the first filter that it does not pass has an odd place."""
    out = F.lit(len(levels) % 2 == 1)
    for place in reversed(range(len(levels))):
        out = F.when(contains(key, levels[place]), out).otherwise(F.lit(place % 2 == 1))
    return out


def level_size(count: int, wrong: float, number: int) -> Level:
    """An empty filter for so many keys that lets through that share of others."""
    hashes = max(1, round(math.log2(1 / wrong)))
    return Level([], max(64, math.ceil(count * hashes * 1.4427)), hashes, number)


def filled(keys: DataFrame, empty: Level) -> Level:
    """The filter with the bits of the keys, gathered as words."""
    at = keys.select(F.explode(F.array(*positions(F.col("key"), empty))).alias("p"))
    words = at.groupBy(F.shiftright("p", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(pmod(p, 64) as int))")).alias("value")
    )
    out = [0] * -(-empty.bits // 64)
    for row in words.collect():
        out[row.word] = row.value
    return Level(out, empty.bits, empty.hashes, empty.number)


def build_cascade(keys: DataFrame, universe: DataFrame, corpus_keys: int, seed: int = 0) -> list[Level]:
    """Levels for the listed keys over all corpus keys (column ``key``, repeats allowed)."""
    count = keys.count()
    if not count:
        return []
    first = filled(keys, level_size(count, min(0.5, count / (math.sqrt(2) * max(corpus_keys, 1))), seed))
    levels = [first]
    wrong = universe.filter(contains(F.col("key"), first)).join(keys, "key", "left_anti").distinct()
    include, exclude = staged(wrong, "passed"), keys
    while n := include.count():
        level = filled(include, level_size(n, 0.5, seed + len(levels)))
        levels.append(level)
        include, exclude = staged(exclude.filter(contains(F.col("key"), level)), "passed"), include
    return levels


def judge_urls(pages: DataFrame, rules: DataFrame, page_id: str = "page_id", url: str = "url", most_bytes: int = MOST_BYTES) -> DataFrame:
    """Per page: id, host, path, the rule that decides (NULL for none) and the verdict."""
    named = parsed(pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url")), "url").drop("url")
    table = staged(rule_table(rules), "rules")
    shape = table.agg(
        F.count("*").alias("n"), F.max(F.size(F.split("host", "[.]"))).alias("labels"), F.collect_set("reach").alias("reaches")
    ).first()
    keyed = named.withColumn("keys", keys_of(shape.labels or 0, sorted(shape.reaches)))
    universe = keyed.select(F.explode("keys.key").alias("key"))
    corpus_keys = universe.agg(F.approx_count_distinct("key")).first()[0]
    bits = shape.n * (1.4427 * math.log2(max(2, 2 * corpus_keys / max(1, shape.n))) + 3)
    if bits / 8 > most_bytes:
        return _joined(keyed, table)
    lists = {a: table.filter(F.col("action") == a).select("key") for a in ("block", "allow")}
    cascades = {a: build_cascade(keys, universe, corpus_keys, 1000 * i) for i, (a, keys) in enumerate(lists.items())}

    def marked(key: Column) -> Column:
        return F.when(listed(key, cascades["block"]), "block").when(listed(key, cascades["allow"]), "allow")

    found = F.transform("keys", lambda k: F.struct(F.length(k["key"]), F.length(k["host"]), marked(k["key"]).alias("action"), k["key"].alias("key")))
    best = F.array_max(F.filter(found, lambda k: k["action"].isNotNull()))
    return _verdicts(keyed.withColumn("best", best))


def _joined(keyed: DataFrame, table: DataFrame) -> DataFrame:
    """The same by a join on the keys, for lists too long for filters. Pages without a candidate stay."""
    rows = keyed.withColumn("row", F.monotonically_increasing_id())
    each = rows.select("row", F.inline("keys")).join(table.select("key", "action"), "key")
    order = F.struct(F.length("key"), F.length("host"), F.col("action").alias("action"), F.col("key").alias("key"))
    best = each.groupBy("row").agg(F.max(order).alias("best"))
    return _verdicts(rows.join(best, "row", "left"))


def _verdicts(rows: DataFrame) -> DataFrame:
    verdict = F.coalesce("best.action", F.lit(DEFAULT)).alias("verdict")
    return rows.select("page_id", "host", "path", F.col("best.key").alias("rule"), verdict)
