"""Secret scan: fixed patterns, and sliding-window entropy over candidate strings, on built-in functions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import id_text, read_table
from .native import let, spans, text_or_empty

# The patterns of the contract. `{14,}` and `{16,}` stand for "18 and 16 characters or more": these
# kinds match whole runs, so a run that is too short holds no other match.
ASSIGN = "(?i:password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = "AKIA[A-Z0-9]{14,}"
HEX = "[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "entropy")

#: Characters of the window that entropy is taken over.
WINDOW = 20
#: Character classes: name, pattern of its runs, least entropy in bits of some window, what such a window must match.
#: The last is the class's allow-list of plain things: a window of a base64 run needs a digit beside a letter twice, so
#: paths, compounds of words, version numbers and dates are none.
_BESIDE = "(?:[0-9][A-Za-z]|[A-Za-z][0-9])"
CLASSES = (
    ("hex", "[0-9A-Fa-f]{20,}", 3.0, "[0-9].*[A-Fa-f]|[A-Fa-f].*[0-9]"),
    ("base36", "[0-9a-z]{20,}|[0-9A-Z]{20,}", 3.5, "[0-9].*[A-Za-z]|[A-Za-z].*[0-9]"),
    ("base64", "[A-Za-z0-9+/_=-]{20,}", 3.9, f"{_BESIDE}.*{_BESIDE}"),
)
#: Runs that are no secrets, whole; and what makes a single window none, so that a key beside a placeholder still counts.
UUID = "^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"
PLACEHOLDER = "(?i)example|sample|placeholder|dummy|xxxx|0000000"
#: Characters of a run that are looked at together; blocks overlap by a window less one, so that no window is missed.
_BLOCK = 256
#: c log2 c in millionths, for counts 0 to WINDOW.
WEIGHTS = [round(1_000_000 * c * math.log2(c)) if c else 0 for c in range(WINDOW + 1)]


def least_sum(entropy: float) -> int:
    """The highest sum of c log2 c, in millionths, that a window of at least this entropy has."""
    return int(WINDOW * (math.log2(WINDOW) - entropy) * 1_000_000)


def _count(window: Column, char: Column) -> Column:
    return F.length(window) - F.length(F.replace(window, char, F.lit("")))


def random_window(value: Column, entropy: float, needs: str) -> Column:
    """Whether some window of value has at least this entropy, matches needs and holds no placeholder.

    The window moves by a character: the count of the one that enters goes up, that of the one that leaves goes down,
    and only these two change the sum of c log2 c. A value shorter than the window has none.
    """
    gain = F.array(*[F.lit(0), *[F.lit(WEIGHTS[c] - WEIGHTS[c - 1]) for c in range(1, WINDOW + 1)]])
    most, char = least_sum(entropy), lambda b, i: F.substr(b, i, F.lit(1))

    def step(block: Column):
        def move(acc: Column, i: Column) -> Column:  # i counts from 1
            window = F.substr(block, F.greatest(i - (WINDOW - 1), F.lit(1)), F.least(i, F.lit(WINDOW)))
            before = F.substr(block, i - WINDOW, F.lit(WINDOW))
            lost = F.when(i > WINDOW, F.get(gain, _count(before, char(block, i - WINDOW)))).otherwise(F.lit(0))
            total = acc["s"] + F.get(gain, _count(window, char(block, i))) - lost
            odd = (i >= WINDOW) & (total <= most) & window.rlike(needs) & ~window.rlike(PLACEHOLDER)
            return let(total, lambda t: F.struct(t.alias("s"), F.when(acc["hit"], F.lit(True)).otherwise(odd).alias("hit")))

        return move

    zero = F.struct(F.lit(0).alias("s"), F.lit(False).alias("hit"))
    found = lambda b: F.aggregate(F.sequence(F.lit(1), F.length(b)), zero, step(b), lambda acc: acc["hit"])
    parts = lambda a: F.transform(a, lambda b, i: F.concat(b, F.coalesce(F.substr(F.get(a, i + 1), F.lit(1), F.lit(WINDOW - 1)), F.lit(""))))
    return let(F.regexp_extract_all(value, F.lit(f".{{1,{_BLOCK}}}"), F.lit(0)), lambda a: F.exists(parts(a), found))


def random_spans(text: Column, pattern: str, entropy: float, needs: str) -> Column:
    """The runs of a class that hold a random window and are no UUID."""
    mixed = lambda v: v.rlike("[0-9]") & v.rlike("[A-Za-z]") & ~v.rlike(UUID)
    return F.filter(spans(text, pattern), lambda x: F.when(mixed(x["value"]), random_window(x["value"], entropy, needs)).otherwise(F.lit(False)))


def _kind(found: Column, kind: int) -> Column:
    return F.transform(found, lambda x: F.struct(x["start"].alias("start"), F.lit(kind).alias("kind"), x["end"].alias("end")))


def _listed(found: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


def secret_spans(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, assign, access, hex, entropy (arrays of start, kind, end), base and all, sorted.

    Spans are in code points of the whole text, end exclusive; an assignment's span is the whole match. Null and empty
    texts have none; an empty table gives no rows, rows that repeat are scanned each, other columns are ignored. Matches
    are leftmost and do not overlap within a kind; those that fail their length are dropped without another try. A
    random run inside a span of the fixed kinds, or inside a random run of a wider class, is not named again.
    """
    rows = id_text(docs, id_col, text_col).withColumn("text", text_or_empty(F.col("text")))
    text, none = F.col("text"), F.array().cast("array<struct<start:bigint,end:bigint,value:string>>")
    sized = F.filter(spans(text, ASSIGN), lambda x: F.length(F.regexp_extract(x["value"], ASSIGN, 1)) >= 12)
    likely = text.rlike("[0-9]") & text.rlike(CLASSES[-1][1])
    rows = rows.select(
        "doc_id", "text", F.when(text.rlike(ASSIGN), sized).otherwise(none).alias("assign"), F.when(F.contains(text, F.lit("AKIA")), spans(text, ACCESS)).otherwise(none).alias("access"),
        F.when(text.rlike(HEX), spans(text, HEX)).otherwise(none).alias("hex"),
        F.when(likely, F.concat(*[random_spans(text, pattern, entropy, needs) for _, pattern, entropy, needs in CLASSES])).otherwise(none).alias("random"),
    )
    base = F.array_sort(F.concat(_kind(F.col("assign"), 0), _kind(F.col("access"), 1), _kind(F.col("hex"), 2)))
    inside = lambda x, b: F.exists(b, lambda y: (y["start"] <= x["start"]) & (y["end"] >= x["end"]))
    wider = lambda x, b: F.exists(b, lambda y: (y["start"] <= x["start"]) & (y["end"] >= x["end"]) & (y["end"] - y["start"] > x["end"] - x["start"]))
    rows = rows.withColumn("base", base).withColumn("random", F.array_distinct(_kind(F.col("random"), 3)))
    rows = rows.withColumn("entropy", F.array_sort(F.filter("random", lambda x: ~inside(x, F.col("base")) & ~wider(x, F.col("random")))))
    return rows.select("doc_id", "assign", "access", "hex", "entropy", "base", F.array_sort(F.concat("base", "entropy")).alias("all"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_spans(read_table(spark, sf_dir, "documents"))
    counts = [F.size(k).cast("long").alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts[:3], F.sha2(_listed(F.col("base")).cast("binary"), 256).alias("base_sha256"), _listed(F.col("all")).alias("spans"), counts[3])
