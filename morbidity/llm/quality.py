"""Quality rules as a short-circuit cascade. Spark's own functions only."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from morbidity.llm.common import BLANKS, table
from morbidity.sources.writers import stage

SAMPLE_ROWS = 2_000  # about so many rows serve to estimate costs and rejections
GRAM = 5


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: str  # SQL over text and the base columns; null counts as not rejecting


#: Fixed thresholds of the cascade's rules.
RULES = (
    Rule("symbols", "n_symbols > n_words"),
    Rule("word_length", "word_chars < 2 * n_words or word_chars > 15 * n_words"),
    Rule("repeated_lines", "2 * n_dup_lines > (length(text) - length(translate(text, '\n', '')) + 1)"),
    Rule("few_letters", r"2 * length(regexp_replace(text, '\\P{L}+', '')) < word_chars"),
    Rule("upper_case", r"2 * length(regexp_replace(text, '[^A-Z]+', '')) > word_chars"),
)


def base_columns(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with counts of the whole text (null: all 0); columns of these names are replaced.

    ``n_words``; ``word_chars``, code points in words; ``n_symbols``; ``n_dup_lines``, lines with a word equal to an earlier
    line; ``n_repeat_words``, words in windows of five that the text has twice or more; ``base_failed``.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    words = F.array_remove(F.split(whole, BLANKS), "")
    counts = let(words, lambda w: F.struct(F.size(w).cast("long").alias("n"), _repeated(w).cast("long").alias("again")))
    based = docs.withColumn("__counts", counts).withColumns(
        {
            "n_words": F.col("__counts.n"),
            "word_chars": F.length(F.translate(whole, " \t\n\x0b\x0c\r", "")).cast("long"),
            "n_symbols": (F.length(whole) - F.length(F.translate(whole, "#*$%&|<>", ""))).cast("long"),
            "n_dup_lines": let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")),
            "n_repeat_words": F.col("__counts.again"),
            "base_failed": (F.col("__counts.n") < 10) | (100 * F.col("__counts.again") > 20 * F.col("__counts.n")),
        }
    )
    return based.drop("__counts")


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)``, with the value worked out once.

    Spark may copy the expression behind a column into each place that uses it, also into a function that runs for each element
    of an array. A value bound to a lambda's variable stays bound.
    """
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _repeated(words: Column) -> Column:
    """Words in windows of ``GRAM`` that occur twice or more."""
    n = F.size(words)
    starts = F.when(n >= GRAM, F.sequence(F.lit(1), n - (GRAM - 1))).otherwise(F.array().cast("array<int>"))
    grams = F.transform(starts, lambda i: F.xxhash64(F.slice(words, i, F.lit(GRAM))))

    def covered(placed: Column) -> Column:
        """Windows in order of hash: those equal to a neighbour, by their places, each adding the words not covered before."""

        def repeats(x: Column, k: Column) -> Column:
            same = F.coalesce(F.get(placed, k - 1)["g"] == x["g"], F.lit(False))
            return same | F.coalesce(F.get(placed, k + 1)["g"] == x["g"], F.lit(False))

        return F.aggregate(
            F.array_sort(F.transform(F.filter(placed, repeats), lambda x: x["i"])),
            F.struct(F.lit(0).alias("n"), F.lit(-GRAM).alias("last")),
            lambda a, i: F.struct((a["n"] + F.least(F.lit(GRAM), i - a["last"])).alias("n"), i.alias("last")),
            lambda a: a["n"],
        )

    def count(g: Column) -> Column:
        placed = F.array_sort(F.transform(g, lambda x, i: F.struct(x.alias("g"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(g)) < F.size(g), let(placed, covered)).otherwise(F.lit(0))

    return let(grams, count)


def rejects(rule: Rule) -> Column:
    return F.coalesce(F.expr(rule.rejects), F.lit(False))


def cascade_order(based: DataFrame, rules: tuple[Rule, ...] = RULES) -> list[Rule]:
    """The rules by rejections per second, each estimated among the sampled rows ``based`` that pass those before it.

    The sample is staged; each rule is timed on it, and the driver gets the number of rows for each combination of answers. The order decides how much work is done, never which rows are kept.
    """
    sample = stage(based, "sample").where(~F.col("base_failed"))
    cost = {}
    for rule in rules:
        began = time.perf_counter()
        sample.agg(F.count_if(rejects(rule))).first()
        cost[rule.name] = time.perf_counter() - began
    flags = [rejects(r).alias(r.name) for r in rules]
    seen = [(r.asDict(), r["count"]) for r in sample.select(*flags).groupBy(*[r.name for r in rules]).count().collect()]
    order, left = [], list(rules)
    while left:
        gain = {r.name: sum(n for row, n in seen if row[r.name]) / max(cost[r.name], 1e-6) for r in left}
        best = max(left, key=lambda r: gain[r.name])
        order.append(best)
        left.remove(best)
        seen = [(row, n) for row, n in seen if not row[best.name]]
    return order


def judge(based: DataFrame, order: list[Rule]) -> DataFrame:
    """Adds ``rejected_by``, the first rule in order that rejects the row (``base`` comes first), and ``kept``. A row's later rules are not worked out."""
    chain = F.when(F.col("base_failed"), F.lit("base"))
    for rule in order:
        chain = chain.when(rejects(rule), F.lit(rule.name))
    return based.withColumn("rejected_by", chain).withColumn("kept", F.col("rejected_by").isNull())


def rate(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``docs`` with the base columns, ``rejected_by`` and ``kept``. Null and wordless texts fail the base rule. Repeated rows are each judged."""
    plain = docs.drop("rejected_by", "kept", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    return judge(base_columns(plain), cascade_order(base_columns(_drawn(plain, sample_rows)), rules))


def _drawn(docs: DataFrame, sample_rows: int) -> DataFrame:
    """About ``sample_rows`` rows for the estimate, drawn by a hash before anything is worked out on them."""
    share = min(1.0, sample_rows / max(1, docs.count()))
    return docs.where(F.pmod(F.xxhash64("text", F.lit(9)), F.lit(1_000_000)) < int(share * 1_000_000))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated = rate(table(spark, sf_dir, "documents", "doc_id", "text"))
    return rated.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


OP9_SQL = r"""
with d as (select doc_id, coalesce(text, '') as text, row_number() over () as rid from documents),
w as (
  select *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as ws,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as ls from d),
g as (select rid, i, array_to_string(ws[i:i+4], ' ') as gram from (select rid, ws, unnest(generate_series(1, len(ws) - 4)) as i from w)),
r as (
  select rid, count(distinct place) as n from (
    select rid, i + unnest([0, 1, 2, 3, 4]) as place from (select *, count(*) over (partition by rid, gram) as c from g) where c > 1)
  group by rid),
b as (
  select doc_id, text, cast(len(ws) as bigint) as n_words,
    cast(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) as bigint) as word_chars,
    cast(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
    cast(len(ls) - len(list_distinct(ls)) as bigint) as n_dup_lines, cast(coalesce(r.n, 0) as bigint) as n_repeat_words
  from w left join r on w.rid = r.rid),
f as (select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed from b)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not (base_failed
    or n_symbols > n_words
    or word_chars < 2 * n_words or word_chars > 15 * n_words
    or 2 * n_dup_lines > len(string_split(text, chr(10)))
    or 2 * length(regexp_replace(text, '\P{L}+', '', 'g')) < word_chars
    or 2 * length(regexp_replace(text, '[^A-Z]+', '', 'g')) > word_chars) as kept
from f
"""
