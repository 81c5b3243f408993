"""Quality rules as a short-circuit cascade of native expressions.

Every document gets its base figures; a rule is a condition that rejects it. The
rules' order does not change which documents stay, only how soon a bad one is
recognised: on a bounded sample each rule is timed and its share of rejections
counted, and rules are asked in the order of rejections for their time. A
document that one rule rejects is not put to the next.

Words are runs of other than white space (space, tab to carriage return). A NULL
or empty text has no words, so it fails the base rules. Rows are judged one by
one, equal or not; an empty table gives no rows.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cabrank.llm.common import staged

SPACE = r"[\x20\x09-\x0D]+"
BLANKS = " \t\n\v\f\r"
SYMBOLS = r"[#*$%&|<>]"
SAMPLE_ROWS = 500
SAMPLE_BYTES = 64 << 10
REPEATS = 20
ROUNDS = 3
LEAST_S = 0.001
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

#: The words of windows whose hash is found again, each counted once: windows sorted by hash, those with an equal
#: neighbour by place, and up to three words each that the window before does not cover.
REPEATED = """
case when size({hashes}) < 2 or size(array_distinct({hashes})) = size({hashes}) then 0L else
  aggregate(
    sort_array(flatten(transform(
      array(sort_array(transform({hashes}, (h, i) -> named_struct('h', h, 'i', i)))),
      s -> transform(
        filter(s, (x, k) -> (k > 0 and s[k - 1].h = x.h) or (k + 1 < size(s) and s[k + 1].h = x.h)),
        x -> x.i)))),
    named_struct('last', -3, 'n', 0L),
    (a, i) -> named_struct('last', i, 'n', a.n + least(3, i - a.last)),
    a -> a.n)
end
"""


@dataclass(frozen=True)
class Rule:
    """Rejects where the condition, on the columns of ``figures`` and the text, is true."""

    name: str
    rejects: str


#: Fixed by the task: the base rules, then the ones of this cascade.
BASE_RULES = (
    Rule("few_words", "n_words < 50"),
    Rule("repeated_words", "100 * n_repeat_words > 50 * n_words"),
)
RULES = (
    *BASE_RULES,
    Rule("symbols", "10 * n_symbols > n_words"),
    Rule("repeated_lines", "10 * n_dup_lines > 3 * n_lines"),
    Rule("word_length", "word_chars > 15 * n_words or word_chars < 2 * n_words"),
    Rule("capitals", r"2 * length(regexp_replace({text}, '[^\\p{{Lu}}]+', '')) > word_chars"),
    Rule("exclamations", r"10 * size(regexp_extract_all({text}, '!!+', 0)) > 3 * n_words"),
)


def figures(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows with their words, their lines that have a word, and the base figures. NULL text counts as empty."""
    trimmed = F.btrim(F.col(text), F.lit(BLANKS))
    words = F.when(F.length(trimmed) > 0, F.split(trimmed, SPACE)).otherwise(F.array().cast("array<string>"))
    lines = F.filter(F.split(F.col(text), "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    rows = docs.withColumn(text, F.coalesce(text, F.lit(""))).withColumns({"words": words, "lines": lines})
    hashes = F.expr(
        "case when size(words) < 3 then cast(array() as array<bigint>) else"
        " flatten(transform(array(words), w -> transform(sequence(0, size(w) - 3),"
        " i -> xxhash64(w[i], w[i + 1], w[i + 2])))) end"
    )
    rows = rows.withColumn("hashes", hashes)
    return rows.withColumns(
        {
            "n_words": F.size("words").cast("long"),
            "word_chars": F.length(F.array_join("words", "")).cast("long"),
            "n_symbols": F.size(F.regexp_extract_all(text, F.lit(SYMBOLS), F.lit(0))).cast("long"),
            "n_lines": F.size("lines").cast("long"),
            "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
            "n_repeat_words": F.expr(REPEATED.format(hashes="hashes")).cast("long"),
        }
    ).drop("words", "lines", "hashes")


def condition(rule: Rule, text: str = "text") -> Column:
    return F.expr(rule.rejects.format(text=f"`{text}`"))


def drawn(docs: DataFrame, text: str = "text", rows: int = SAMPLE_ROWS) -> DataFrame:
    """The texts of the rows with the smallest hashes, from all files alike; of one beyond ``SAMPLE_BYTES`` a stretch.

    The stretch is at a hashed place and has a quarter as many characters, so the
    sample has a bounded size. Only about twice as many rows as asked for are sorted.
    """
    part = SAMPLE_BYTES // 4
    one_in = max(1, docs.count() // (2 * rows))
    found = docs.withColumn("order", F.xxhash64(*docs.columns)).filter(F.pmod("order", F.lit(one_in)) == 0)
    start = F.pmod("order", F.greatest(F.length(text) - part, F.lit(0)) + 1) + 1
    cut = F.when(F.octet_length(text) > SAMPLE_BYTES, F.substr(text, start.cast("int"), F.lit(part))).otherwise(F.col(text))
    return found.select("order", cut.alias("text")).orderBy("order").limit(rows).select("text")


def ordered(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", rows: int = SAMPLE_ROWS) -> tuple[Rule, ...]:
    """The rules by their rejections on a sample for the time they took, best first.

    The sample's figures are staged, as every row has them anyway. A rule is timed
    on rows that repeat the sample, after a warm-up: the shortest of some rounds,
    less that of a job without a rule. A rule that rejects nothing goes last.
    """
    sample = staged(figures(drawn(docs, text, rows)), "rules")
    repeated = sample.withColumn("round", F.explode(F.sequence(F.lit(1), F.lit(REPEATS))))

    def asked(rejects: Column) -> tuple[int, float]:
        rejected, *times = [_timed(repeated.agg(F.count_if(rejects))) for _ in range(ROUNDS + 1)]
        return rejected[0], min(took for _, took in times)

    _, start = asked(F.length("text") < 0)
    measured = []
    for rule in rules:
        rejected, took = asked(condition(rule))
        measured.append((rejected / max(took - start, LEAST_S), rule))
    return tuple(rule for _, rule in sorted(measured, key=lambda x: -x[0]))


def _timed(count: DataFrame) -> tuple[int, float]:
    begun = time.perf_counter()
    return count.first()[0], time.perf_counter() - begun


def cascade(rules: tuple[Rule, ...], text: str = "text") -> Column:
    """The name of the first rule that rejects, NULL for none; later rules are not evaluated."""
    out = F.lit(None).cast("string")
    for rule in reversed(rules):
        out = F.when(condition(rule, text), F.lit(rule.name)).otherwise(out)
    return out


def judge(docs: DataFrame, rules: tuple[Rule, ...] | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: id, base figures, whether a base rule fails, and whether it is kept.

    A document that fails a base rule is never kept, whatever rules are given.
    """
    named = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    rules = ordered(named) if rules is None else rules
    failed = condition(BASE_RULES[0]) | condition(BASE_RULES[1])
    rows = figures(named)
    return rows.select("doc_id", *BASE, failed.alias("base_failed"), (~failed & cascade(rules).isNull()).alias("kept"))


def keep(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """The rows that no rule rejects, with the columns they came with."""
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col(text).alias("text"))
    return figures(rows).filter(cascade(rules).isNull()).select("row.*")
