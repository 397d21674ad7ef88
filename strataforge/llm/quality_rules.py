"""Quality rules as a short-circuit cascade, on built-in functions only.

Each rule is a boolean column "this document fails". A sample tells what share of documents a rule rejects and what it
costs (the time to evaluate it over the sample); the cascade tries rules by rejection per cost, dearest and rarest last,
in one CASE expression, which stops at the first rule that fails. The verdict does not depend on the order.
"""

from __future__ import annotations

import statistics
import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, id_text, read_table
from .native import let, text_or_empty

WINDOW = 8
#: Documents, about, on which costs and rejections are estimated: each row with the same chance.
SAMPLE = 2000
#: Times that a job over the sample looks at it at most, so that the work shows above what starting a job takes.
MOST_TIMES = 64

#: Words that the share of distinct words is taken over at most; a longer text is judged by the mean over its blocks.
DISTINCT_BLOCK = 5000

_SPACES = "[\\x20\\x09-\\x0D]+"


@dataclass(frozen=True)
class Rule:
    name: str
    fails: Column


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, _SPACES), lambda w: w != "")


def n_dup_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.btrim(x, F.lit(" \t\x0b\x0c\r"))) > 0)
    return let(lines, lambda a: F.size(a) - F.size(F.array_distinct(a)))


def n_repeat_words(words: Column, n: int = WINDOW) -> Column:
    """Words inside windows of n words that the text has twice or more. Windows are told apart by 64-bit hashes."""

    def starts(hashes: Column) -> Column:
        """Sorted starts of windows that occur twice: neighbours in the order of hashes."""
        placed = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        same = lambda p, x, j: (F.get(p, j - 1)["h"] == x["h"]) | (F.get(p, j + 1)["h"] == x["h"])
        return let(placed, lambda p: F.array_sort(F.transform(F.filter(p, lambda x, j: F.coalesce(same(p, x, j), F.lit(False))), lambda x: x["i"])))

    covered = lambda s: F.aggregate(
        F.zip_with(F.slice(s, F.lit(1), F.size(s) - 1), F.slice(s, F.lit(2), F.size(s)), lambda a, b: F.least(b - a, F.lit(n))), F.lit(n), lambda acc, x: acc + x
    )
    windows = lambda w: F.transform(F.sequence(F.lit(1), F.size(w) - n + 1), lambda i: F.xxhash64(F.slice(w, i, F.lit(n))))
    count = lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(let(starts(h), covered))
    return let(words, lambda w: F.when(F.size(w) < n + 1, F.lit(0)).otherwise(let(windows(w), count)))


def with_base(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text, words, n_words and the four counts, base_failed; a null text is as an empty one."""
    rows = id_text(docs, id_col, text_col).withColumn("text", text_or_empty(F.col("text")))
    rows = rows.withColumn("words", words_of(F.col("text")))
    counts = let(F.col("words"), lambda w: F.struct(F.size(w).cast("long").alias("n_words"), n_repeat_words(w).cast("long").alias("n_repeat_words")))
    bare = F.translate("text", " \t\n\x0b\x0c\r", "")
    rows = rows.select(
        "doc_id", "text", "words", counts.alias("c"), F.length(bare).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", "#*$%&|<>", ""))).cast("long").alias("n_symbols"), n_dup_lines(F.col("text")).cast("long").alias("n_dup_lines"),
    )
    failed = (F.col("c.n_words") < 20) | (100 * F.col("c.n_repeat_words") > 30 * F.col("c.n_words"))
    return rows.select("doc_id", "text", "words", "c.n_words", "word_chars", "n_symbols", "n_dup_lines", "c.n_repeat_words", failed.alias("base_failed"))


def few_distinct(words: Column, percent: int, block: int = DISTINCT_BLOCK) -> Column:
    """Whether less than percent of the words are distinct, in the mean over blocks of that many words. The last block
    ends with the text and may overlap the one before; a text of one block at most is judged as it is."""

    def in_blocks(w: Column) -> Column:
        parts = F.transform(F.sequence(F.lit(0), F.floor((F.size(w) - 1) / block).cast("int")), lambda i: F.slice(w, F.least(i * block, F.size(w) - block) + 1, F.lit(block)))
        return let(F.transform(parts, lambda p: F.size(F.array_distinct(p))), lambda d: 100 * F.aggregate(d, F.lit(0).cast("long"), lambda acc, x: acc + x) < percent * block * F.size(d).cast("long"))

    return F.when(F.size(words) <= block, 100 * F.size(F.array_distinct(words)) < percent * F.size(words)).otherwise(let(words, in_blocks))


def default_rules() -> list[Rule]:
    """Rules over the columns of `with_base`; thresholds are shares of words or characters of the whole text."""
    chars, words = F.col("word_chars"), F.col("n_words")
    upper = F.length(F.col("text")) - F.length(F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZÀÁÂÄÇÈÉÊËÌÍÎÏÑÒÓÔÖÙÚÛÜ", ""))
    marks = F.length(F.col("text")) - F.length(F.translate("text", "!?", ""))
    digits = F.length(F.col("text")) - F.length(F.translate("text", "0123456789", ""))
    w = F.col("words")
    next_is_same = F.zip_with(F.slice(w, F.lit(1), F.size(w) - 1), F.slice(w, F.lit(2), F.size(w)), lambda a, b: a == b)
    twice = 100 * F.size(F.filter(next_is_same, lambda x: x)) > 15 * words
    return [
        Rule("symbols", 100 * F.col("n_symbols") > 10 * words),
        Rule("dup_lines", 2 * F.col("n_dup_lines") > F.size(F.split("text", "\n"))),
        Rule("word_length", (chars > 14 * words) | (chars < 2 * words)),
        Rule("upper_case", 100 * upper > 30 * chars),
        Rule("marks", 100 * marks > 10 * words),
        Rule("digits", 100 * digits > 25 * chars),
        Rule("few_words", (words >= 50) & few_distinct(F.col("words"), 20)),
        Rule("stutter", (words >= 20) & twice),
    ]


def rule_order(sample: DataFrame, rules: list[Rule], runs: int = 3) -> list[tuple[Rule, float, float]]:
    """(rule, rejected share, seconds) by rejection per cost; equal rules keep their order, as all do on an empty sample.

    The sample is looked at so many times over in one job that all rules together take several times as long as a rule
    that looks at nothing. A rule's cost is the median of some such jobs, rules taking turns, less the median of the idle
    ones. Rules below a tenth of the dearest cannot be told apart from each other and count as that.
    """
    part, idle = cut(sample), F.lit(0)

    def seconds(fails: Column, times: int) -> float:
        began = time.perf_counter()
        part.select("*", F.explode(F.sequence(F.lit(1), F.lit(times))).alias("_time")).agg(F.sum(fails)).collect()
        return time.perf_counter() - began

    counted = [r.fails.cast("int") for r in rules]
    times = 1
    while times < MOST_TIMES and min(seconds(sum(counted, F.lit(0)), times) for _ in range(2)) < 6 * min(seconds(idle, times) for _ in range(2)):
        times *= 4
    rounds = [[seconds(f, times) for f in (idle, *counted)] for _ in range(runs + 1)][1:]  # the first round compiles
    nothing, *costs = (statistics.median(x) / times for x in zip(*rounds, strict=True))
    costs = [max(c - nothing, 1e-9) for c in costs]
    shares = part.agg(*(F.coalesce(F.avg(f), F.lit(0.0)) for f in counted)).first() if rules else []
    found = [(rule, float(share), max(cost, max(costs) / 10)) for rule, share, cost in zip(rules, shares, costs, strict=True)]
    return sorted(found, key=lambda x: -x[1] / x[2])


def cascade(rules: list[Rule]) -> Column:
    """The name of the first rule, in this order, that a document fails, or null."""
    out = F.lit(None).cast("string")
    for rule in reversed(rules):
        out = F.when(rule.fails, F.lit(rule.name)).otherwise(out)
    return out


def quality_rules(docs: DataFrame, rules: list[Rule] | None = None, *, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> DataFrame:
    """One row per row of docs: doc_id, the counts, base_failed, kept, failed_rule (base first, null where kept).

    Texts without words fail (base: under 20 words). Rows that repeat are judged each. The sample only orders the rules.
    """
    rules = default_rules() if rules is None else rules
    rows = with_base(docs, id_col=id_col, text_col=text_col)
    picked = id_text(docs, id_col, text_col)
    picked = picked.sample(min(1.0, sample / max(1, picked.count())), seed=17)
    ordered = [r for r, _, _ in rule_order(with_base(picked), rules)]
    verdict = F.when(F.col("base_failed"), F.lit("base")).otherwise(cascade(ordered))
    out = rows.withColumn("failed_rule", verdict)
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", F.isnull("failed_rule").alias("kept"), "failed_rule")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    # which rule fails first depends on measured costs, the verdict does not
    return quality_rules(read_table(spark, sf_dir, "documents")).drop("failed_rule")
