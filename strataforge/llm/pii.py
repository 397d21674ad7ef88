"""Personal data: fixed patterns, and terms that give a protected entity away, on built-in functions only.

Entities are the values that the patterns find. A term discloses an entity when the corpus says that seeing the term
all but tells the entity: its pointwise mutual information with the entity comes close to the entity's own information
content. PMI(t, e) = log2(N n(t,e) / (n(t) n(e))) and IC(e) = log2(N / n(e)) over distinct texts; a term is over the
disclosure threshold when PMI >= share * IC, with at least `support` texts that hold both. Where PMI reaches IC (no text
has the term without the entity) the term is removed, else it is generalised.

Terms are counted over whole texts, and marked wherever they stand, in texts without the entity too: there they tell
what the text itself does not name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import checked, cut, id_text, read_table
from .native import let, spans, text_or_empty

# The patterns of the contract. Possessive repeats and the look-behind keep long runs linear in time;
# \G lets a match begin where the one before it ended.
EMAIL = "(?:\\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\\.[A-Za-z0-9-]++)++"
IP = "(?<![0-9])[0-9]++(?:\\.[0-9]++){3}"
CARD = "[0-9](?:[\\x20-]?[0-9])++"
PHONE = "\\+[0-9][\\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone", "term")

#: Terms: runs of letters.
TERM = "\\p{L}+"
SHARE = 0.9
SUPPORT = 3
_SPANS = "array<struct<start:bigint,end:bigint,value:string>>"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the check sum: every second digit from the right counts double, less 9 if over 9."""
    doubled = lambda d: F.when(d > 4, 2 * d - 9).otherwise(2 * d)
    values = lambda r: F.transform(F.sequence(F.lit(1), F.length(r)), lambda i: let(F.substr(r, i, F.lit(1)).cast("int"), lambda d: F.when(i % 2 == 0, doubled(d)).otherwise(d)))
    return let(F.reverse(digits), lambda r: F.aggregate(values(r), F.lit(0), lambda acc, x: acc + x)) % 10 == 0


def _small_parts(value: Column) -> Column:
    number = lambda p: F.coalesce(F.ltrim(p, F.lit("0")).try_cast("bigint"), F.lit(0))
    return F.forall(F.split(value, "[.]"), lambda p: F.when(F.length(F.ltrim(p, F.lit("0"))) <= 3, number(p) <= 255).otherwise(F.lit(False)))


def base_spans(text: Column) -> dict[str, Column]:
    """The spans of each kind; a text without what a kind needs is not searched for it."""
    none = F.array().cast(_SPANS)
    card = lambda x: let(_digits(x["value"]), lambda d: F.when(F.length(d).between(13, 19), luhn(d)).otherwise(F.lit(False)))
    return {
        "email": F.when(F.contains(text, F.lit("@")), spans(text, EMAIL)).otherwise(none),
        "ip": F.when(text.rlike("[0-9]\\.[0-9]+\\.[0-9]+\\.[0-9]"), F.filter(spans(text, IP), lambda x: _small_parts(x["value"]))).otherwise(none),
        "card": F.when(text.rlike("[0-9](?:[\\x20-]?[0-9]){12}"), F.filter(spans(text, CARD), card)).otherwise(none),
        "phone": F.when(F.contains(text, F.lit("+")), F.filter(spans(text, PHONE), lambda x: F.length(_digits(x["value"])).between(9, 15))).otherwise(none),
    }


def _terms(text: Column) -> Column:
    """The distinct terms of a whole text, in lower case."""
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0)))


def _found() -> Column:
    """All base spans of the columns of `base_spans`: array<struct<kind, start, end, value>>."""
    marked = lambda i: lambda x: F.struct(F.lit(i).alias("kind"), x["start"].alias("start"), x["end"].alias("end"), x["value"].alias("value"))
    return F.concat(*[F.transform(k, marked(i)) for i, k in enumerate(KINDS[:4])])


def _with_found(rows: DataFrame) -> DataFrame:
    """rows with found: the base spans of their column text."""
    kept = rows.columns
    return rows.select(*kept, *[c.alias(k) for k, c in base_spans(F.col("text")).items()]).select(*kept, _found().alias("found"))


def detect(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, h (hash of the text), found: its spans (kind, start, end, value), entities, and
    terms: the distinct terms of texts with entities."""
    rows = id_text(docs, id_col, text_col).select("doc_id", text_or_empty(F.col("text")).alias("text"))
    rows = _with_found(rows)
    entity = lambda x: F.concat_ws(":", x["kind"].cast("string"), F.when(x["kind"] == 0, F.lower(x["value"])).when(x["kind"] == 1, x["value"]).otherwise(_digits(x["value"])))
    terms = _terms(F.col("text"))
    return rows.select(
        "doc_id", F.xxhash64("text").alias("h"), "found", F.array_distinct(F.transform("found", entity)).alias("entities"),
        F.when(F.size("found") > 0, terms).otherwise(F.array().cast("array<string>")).alias("terms"),
    )


def _over(pairs: DataFrame, n: int, share: float) -> DataFrame:
    """Pairs (n_te, n_t, n_e) over the threshold among n texts, with pmi and ic."""
    rows = pairs.withColumn("pmi", F.log2(F.col("n_te") * F.lit(float(n)) / (F.col("n_t") * F.col("n_e")))).withColumn("ic", F.log2(F.lit(float(n)) / F.col("n_e")))
    return rows.where((F.col("ic") > 0) & (F.col("pmi") >= share * F.col("ic")))


def _words(docs: DataFrame, text_col: str, terms: DataFrame) -> DataFrame:
    """(h, term), a row for each row of docs and each of its terms that is among `terms` (a column term)."""
    text = text_or_empty(docs[text_col])
    return docs.select(F.xxhash64(text).alias("h"), F.explode(_terms(text)).alias("term")).join(checked(terms), "term", "left_semi")


def _texts_with(docs: DataFrame, text_col: str, found: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, n_t): in how many distinct texts each of `terms` is.

    Texts without a copy are counted row by row, before anything moves; only texts that docs has twice or more move
    with their hash, to count once.
    """
    copied = found.groupBy("h").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("h", F.col("h").alias("copied"))
    words = _words(docs, text_col, terms).join(checked(cut(copied)), "h", "left")
    counts = words.groupBy("term", "copied").agg(F.count(F.lit(1)).alias("k"))
    return counts.groupBy("term").agg(F.sum(F.when(F.col("copied").isNull(), F.col("k")).otherwise(1)).alias("n_t"))


def disclosures(docs: DataFrame, found: DataFrame, *, share: float = SHARE, support: int = SUPPORT, text_col: str = "text") -> DataFrame:
    """(entity, term, pmi, ic, certain) of the terms over the threshold, from counts over all distinct texts."""
    n = found.agg(F.countDistinct("h").alias("n")).first()["n"]
    held = found.where(F.size("entities") > 0).select("h", "entities", "terms").dropDuplicates(["h"])
    holders = held.select("h", F.explode("entities").alias("entity"))
    counts = cut(holders.groupBy("entity").agg(F.count(F.lit(1)).alias("n_e")))
    # a pair is in no more texts than its entity is
    enough = checked(counts.where(F.col("n_e") >= support).select("entity"))
    terms = held.select("h", F.explode("terms").alias("term"))
    beside = cut(holders.join(enough, "entity").join(terms, "h").select("h", "entity", "term"))
    # a term is in at least as many texts as it is beside any entity: pairs that fail with this count fail with the true one
    least = beside.select("h", "term").distinct().groupBy("term").agg(F.count(F.lit(1)).alias("n_t"))
    both = beside.groupBy("entity", "term").agg(F.count(F.lit(1)).alias("n_te")).where(F.col("n_te") >= support)
    both = cut(_over(both.join(counts, "entity").join(least, "term"), n, share).select("entity", "term", "n_te", "n_e"))
    rows = _over(both.join(_texts_with(docs, text_col, found, cut(both.select("term").distinct())), "term"), n, share)
    return rows.select("entity", "term", "pmi", "ic", (F.col("n_t") == F.col("n_te")).alias("certain"))


def personal_spans(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", share: float = SHARE, support: int = SUPPORT) -> DataFrame:
    """One row per row of docs: doc_id, h, found (spans of the fixed kinds: kind, start, end, value), terms (start, end, certain).

    Spans are in code points of the whole text, end exclusive. Matches are leftmost and do not overlap within a kind;
    those that fail a test are dropped without another try. Null and empty texts have no spans, an empty table has no
    rows, other columns are ignored. Copies of a text count once in the corpus counts, so that a text that is often
    repeated discloses nothing by that. Disclosing terms are marked wherever they stand, in all documents, but where
    they overlap or touch a span of the fixed kinds.
    """
    found = cut(detect(docs, id_col=id_col, text_col=text_col))
    told = disclosures(docs, found, share=share, support=support, text_col=text_col)
    told = cut(told.groupBy("term").agg(F.max("certain").alias("certain")))
    here = _words(docs, text_col, told.select("term")).distinct().join(checked(told), "term")
    here = here.groupBy("h").agg(F.collect_list("term").alias("all"), F.collect_list(F.when(F.col("certain"), F.col("term"))).alias("sure"))
    texts = docs.select(text_or_empty(docs[text_col]).alias("text")).withColumn("h", F.xxhash64("text"))
    texts = texts.join(checked(cut(here)), "h").dropDuplicates(["h"])
    telling = F.filter(spans(F.col("text"), TERM), lambda t: F.array_contains("all", F.lower(t["value"])))
    hits = texts.select("h", F.transform(telling, lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end"), F.array_contains("sure", F.lower(t["value"])).alias("certain"))).alias("terms"))
    base = found.where(F.size("found") > 0).select("h", "found").dropDuplicates(["h"])
    hits = hits.join(base, "h", "left")
    beside = lambda t, x: (x["start"] <= t["end"]) & (x["end"] >= t["start"])
    clear = lambda t: ~F.exists("found", lambda x: beside(t, x))
    marks = hits.select("h", F.when(F.col("found").isNull(), F.col("terms")).otherwise(F.filter("terms", clear)).alias("terms"))
    none = F.array().cast("array<struct<start:bigint,end:bigint,certain:boolean>>")
    return found.select("doc_id", "h", "found").join(checked(cut(marks)), "h", "left").select("doc_id", "h", "found", F.coalesce("terms", none).alias("terms"))


def sanitise(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(doc_id, text) with entities replaced by their kind in brackets, certain terms removed, other disclosing terms
    generalised to `[term]`. Of spans that overlap the one that begins first, then the longest, is replaced; the rest of
    an overlapped span goes with it. A null text becomes empty. Rows that repeat id and text are treated alike."""
    found = personal_spans(docs, id_col=id_col, text_col=text_col, **options)
    names = F.array(*[F.lit(f"[{k}]") for k in KINDS])
    fixed = F.transform("found", lambda x: F.struct(x["start"].alias("start"), (-x["end"]).alias("back"), F.get(names, x["kind"]).alias("by")))
    told = F.transform("terms", lambda x: F.struct(x["start"].alias("start"), (-x["end"]).alias("back"), F.when(x["certain"], F.lit("")).otherwise(F.lit("[term]")).alias("by")))
    edits = found.select("doc_id", "h", F.array_sort(F.concat(fixed, told)).alias("edits")).where(F.size("edits") > 0).dropDuplicates(["doc_id", "h"])
    rows = id_text(docs, id_col, text_col).withColumn("text", text_or_empty(F.col("text"))).withColumn("h", F.xxhash64("text"))
    edits = edits.withColumnRenamed("doc_id", "_id").withColumnRenamed("h", "_h")
    rows = rows.join(edits, rows["doc_id"].eqNullSafe(edits["_id"]) & (rows["h"] == edits["_h"]), "left")
    text = F.col("text")

    def put(acc: Column, x: Column) -> Column:
        kept = F.substr(text, (acc["at"] + 1).cast("int"), F.greatest(x["start"] - acc["at"], F.lit(0)).cast("int"))
        return F.struct(F.greatest(acc["at"], -x["back"]).alias("at"), F.when(x["start"] < acc["at"], acc["out"]).otherwise(F.concat(acc["out"], kept, x["by"])).alias("out"))

    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))
    done = F.aggregate("edits", start, put, lambda acc: F.concat(acc["out"], F.substr(text, (acc["at"] + 1).cast("int"))))
    return rows.select("doc_id", F.when(F.size("edits") > 0, done).otherwise(text).alias("text"))


def _listed(found: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.array_sort(found), lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


def _counted(out: DataFrame) -> DataFrame:
    plain = lambda found: F.transform(found, lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end")))
    terms = F.transform("terms", lambda x: F.struct(F.lit(4).alias("kind"), x["start"].alias("start"), x["end"].alias("end")))
    of = lambda i: lambda x: x["kind"] == i
    counts = [F.size(F.filter("found", of(i))).cast("long").alias(f"n_{k}") for i, k in enumerate(KINDS[:4])]
    return out.select(
        "doc_id", *counts, F.sha2(_listed(plain(F.col("found"))).cast("binary"), 256).alias("base_sha256"),
        _listed(F.concat(plain(F.col("found")), terms)).alias("spans"), F.size("terms").cast("long").alias("n_term"),
    )


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _counted(personal_spans(read_table(spark, sf_dir, "documents")))
