"""Hash-keyed change history: a hub of keys, a satellite of states, tables derived from new states, and a summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import fast_hash, joined
from ..operators.rows import top_rows
from .schemas import ITEM_SLOTS, RAW

HUB = ["id", "match_id", "player_id", "minute"]
#: What a state is made of, in the order that goes into its digest.
STATE = [c for c in RAW["intervals"].names if c not in HUB]
_KEY = HUB
ECONOMY = ["current_gold", "total_gold", "cs", "jungle_cs", "xp", "level", "gold_diff", "xp_diff"]
#: The columns of a state that each derived table is made of.
DERIVED = {"kda": ["kills", "deaths", "assists"], "economy": ECONOMY, "items": ITEM_SLOTS, "team_objectives": [c for c in STATE if c.startswith("team_")]}


def _digests() -> tuple[Column, Column]:
    """hub_hash, from the id alone, and diff_hash, from all of the state."""
    return fast_hash(F.col("id").cast("string")), fast_hash(joined([F.col(c) for c in STATE]))


def with_hashes(staged: DataFrame) -> DataFrame:
    """staged with hub_hash and diff_hash."""
    hub, diff = _digests()
    return staged.withColumn("hub_hash", hub).withColumn("diff_hash", diff)


def _fresh(target: DataFrame, staged: DataFrame, keys: list[str], columns: list[str], small: bool) -> DataFrame:
    """One row per key that target does not have: the earliest, of equally early ones the least. Keys are digests, or null.

    Staged rows and the keys of target move once, together, by the first key. Staged rows without digests move as text and
    get them where they arrive: digests don't compress, and rows of one id, which then lie together, do. If staged rows are
    few (small), target is first cut to the keys they have, by a semi join that they are broadcast to.
    """
    whole = lambda c: F.coalesce(c, F.lit(b"").cast("binary"))  # noqa: E731  no digest is empty
    names, values = [f"_{k}" for k in keys], [c for c in columns if c not in ("ldts", *keys)]
    known = target.select(*[whole(F.col(k)).alias(f"_{k}") for k in keys])
    if small:
        asked = (staged if keys[0] in staged.columns else with_hashes(staged)).select(*[whole(F.col(k)).alias(f"_{k}") for k in keys])
        known = known.join(F.broadcast(asked.distinct()), names, "left_semi")
    if keys[0] in staged.columns:
        digests = {k: F.col(k) for k in keys}
    else:
        digests = {k: v for k, v in zip(("hub_hash", "diff_hash"), _digests(), strict=True) if k in keys}
    here = staged.withColumn("_known", F.lit(False))
    rows = here.unionByName(known.withColumn("_known", F.lit(True)), allowMissingColumns=True)
    digest = {n: F.when(F.col("_known"), F.col(n)).otherwise(whole(digests[k])) for n, k in zip(names, keys, strict=True)}
    rows = rows.repartition(digest[names[0]]).select(*[v.alias(f"_{n}") for n, v in digest.items()], "_known", "ldts", *values)
    first = top_rows(rows, [f"_{n}" for n in names], [F.col("_known").desc(), F.col("ldts").asc(), *[F.col(c).asc() for c in values]])
    return first.where(~F.col("_known")).select(*[F.nullif(F.col(f"__{c}"), F.lit(b"").cast("binary")).alias(c) if c in keys else c for c in columns])


def new_hub_rows(hub: DataFrame, staged: DataFrame, small: bool = False) -> DataFrame:
    """Keys that the hub does not have; one that comes several times counts with its earliest row."""
    return _fresh(hub, staged, ["hub_hash"], ["hub_hash", *HUB, "ldts", "rsrc"], small)


def new_states(satellite: DataFrame, staged: DataFrame, small: bool = False) -> DataFrame:
    """States whose (hub_hash, diff_hash) has not been seen: one that returns to an older value is not recorded again."""
    return _fresh(satellite, staged, ["hub_hash", "diff_hash"], ["hub_hash", "ldts", "rsrc", *STATE, "diff_hash"], small)


#: Between the values of a packed state, and in place of one that is null.
_BETWEEN, _NULL = "\x1f", "\x00"


def with_key(staged: DataFrame) -> DataFrame:
    """staged with key, the text that hub_hash is the digest of. Rows that lie bucketed by it need not move, and it
    compresses, which digests don't."""
    return staged.withColumn("key", F.upper(F.trim(F.col("id").cast("string"))))


def hashed(rows: DataFrame, columns: list[str]) -> DataFrame:
    """columns of rows that have key and state, hub_hash and diff_hash among them."""
    digests = {"hub_hash": F.unhex(F.sha1("key")), "diff_hash": _digests()[1]}
    return rows.select([digests[c].alias(c) if c in digests else c for c in columns])


def _packed(rows: DataFrame, columns: list[str], *kept: str) -> DataFrame:
    """kept columns of rows, with others, which are text, as one text, _text, which a sort holds in a third of the memory;
    and as an array, _odd, where one holds what the text is packed with, else null.

    Here and in `_unpacked` all columns are one array: written out for each column it is too large for the JIT.
    """
    rows = rows.select(*kept, F.array(*columns).alias("_odd")).withColumn("_text", F.array_join("_odd", _BETWEEN, _NULL))
    between = F.octet_length("_text") - F.octet_length(F.replace(F.col("_text"), F.lit(_BETWEEN), F.lit("")))
    odd = (between != len(columns) - 1) | (F.contains(F.col("_text"), F.lit(_NULL)) & F.exists("_odd", lambda v: F.coalesce(F.contains(v, F.lit(_NULL)), F.lit(False))))
    return rows.withColumn("_odd", F.when(odd, F.col("_odd")))


def _unpacked(rows: DataFrame, columns: list[str], *kept: str) -> DataFrame:
    values = F.split("_text", _BETWEEN)
    values = F.when(F.contains(F.col("_text"), F.lit(_NULL)), F.transform(values, lambda v: F.when(v != _NULL, v))).otherwise(values)
    rows = rows.select(*kept, F.coalesce("_odd", values).alias("_values"))
    return rows.select(*kept, *[F.get("_values", F.lit(i)).alias(c) for i, c in enumerate(columns)])


def first_hub_rows(rows: DataFrame) -> DataFrame:
    """As `new_hub_rows`, of rows with key, staged (_known is false) and of the hub, in one table that is bucketed by key."""
    values = [*HUB, "rsrc"]
    rows = rows.select("key", "_known", "ldts", *values)
    first = top_rows(rows, ["key"], [F.col("_known").desc(), F.col("ldts").asc(), *[F.col(c).asc() for c in values]])
    return first.where(~F.col("_known")).drop("_known")


def first_states(rows: DataFrame) -> DataFrame:
    """As `new_states`, of rows with key, staged (_known is false) and of the satellite, in one table that is bucketed by key.
    Two states have one digest if their texts are equal after what `fast_hash` does to them; so these are compared."""
    text = F.replace(F.replace(F.col("_text"), F.lit(_NULL), F.lit("")), F.lit(_BETWEEN), F.lit("^"))
    state = F.upper(F.trim(F.when(F.col("_odd").isNull(), text).otherwise(F.array_join("_odd", "^", ""))))
    rows = _packed(rows, STATE, "key", "_known", "ldts", "rsrc").withColumn("_state", state)
    first = top_rows(rows, ["key", "_state"], [F.col("_known").desc(), F.col("ldts").asc(), F.col("rsrc").asc(), F.col("_text").asc(), F.col("_odd").asc()])
    return _unpacked(first.where(~F.col("_known")), STATE, "key", "ldts", "rsrc")


def _number(column: str) -> Column:
    return F.col(column).cast("decimal(38,0)")


def _ratio(over: Column, under: str) -> Column:
    return (over / F.nullifzero(_number(under))).cast("decimal(10,2)")


def numbered(states: DataFrame, hub: DataFrame, columns: list[str] = STATE) -> DataFrame:
    """States as numbers, each with the key of its row of the hub; of all columns or some. Joined by the key where both have
    it, which may lie bucketed by it, or else by hub_hash."""
    by = "key" if "key" in states.columns and "key" in hub.columns else "hub_hash"
    keys = hub.select(by, "id", "match_id", "player_id", F.col("minute").try_cast("bigint").alias("minute"))
    numbers = F.transform(F.array(*columns), lambda v: v.try_cast("bigint"))  # one expression: written out for each column it is too large for the JIT
    rows = states.select(by, numbers.alias("s")).join(keys if by == "hub_hash" else keys.hint("merge"), by)  # a few columns of a large hub pass for small
    return rows.select(*_KEY, *[F.get("s", F.lit(i)).alias(c) for i, c in enumerate(columns)])


def derived(rows: DataFrame, targets: tuple[str, ...] = tuple(DERIVED)) -> dict[str, DataFrame]:
    """The derived tables of numbered states, which need the columns of those: combat, economy, items, team objectives."""
    kda = _ratio((F.col("kills") + F.col("assists")).cast("decimal(38,0)"), "deaths")
    objectives = F.col("team_dragons") + F.col("team_barons") + F.col("team_heralds") + F.col("team_void_grubs")
    more = {
        "kda": [kda.alias("kda_ratio")],
        "economy": [(F.col("cs") + F.col("jungle_cs")).alias("net_cs"), _ratio(_number("total_gold"), "minute").alias("gold_per_min")],
        "items": [],
        "team_objectives": [objectives.alias("total_objectives")],
    }
    return {t: rows.select(*_KEY, *DERIVED[t], *more[t]) for t in targets}


def partitions(states: DataFrame, hub: DataFrame) -> dict[str, DataFrame]:
    """The derived tables of new states, which are text. Each joins the hub anew; who needs several stores `numbered`."""
    return derived(numbered(states, hub))


def player_summary(kda: DataFrame, economy: DataFrame) -> DataFrame:
    """A row per player of a match: values at the last minute, of several rows there the one with the largest id, and
    rates over its minutes. Of a key with several rows the largest count. All rows move once, by player."""
    combat, wealth = ["kills", "deaths", "assists", "kda_ratio"], ["total_gold", "net_cs", "level", "gold_diff"]
    rows = kda.select(*_KEY, F.struct(*combat).alias("k")).unionByName(economy.select(*_KEY, F.struct(*wealth).alias("e")), allowMissingColumns=True)
    rows = rows.dropna(subset=_KEY).repartition("match_id", "player_id").groupBy(*_KEY).agg(F.max("k").alias("k"), F.max("e").alias("e"), F.max("e.gold_diff").alias("peak"))
    rows = rows.where("k is not null and e is not null").groupBy("match_id", "player_id")
    last = rows.agg(F.max("minute").alias("game_duration"), F.max_by(F.struct("k.*", "e.*"), F.struct("minute", "id")).alias("f"), F.max("peak").alias("peak_gold_advantage"))
    final = {"final_kills": "kills", "final_deaths": "deaths", "final_assists": "assists", "final_kda_ratio": "kda_ratio", "final_gold": "total_gold", "final_cs": "net_cs", "final_level": "level"}
    rate = lambda c: F.col(f"f.{c}").cast("decimal(20,0)") / F.nullifzero(F.col("game_duration")).cast("decimal(20,0)")
    return last.select(
        "match_id", "player_id", "game_duration", *[F.col(f"f.{c}").alias(k) for k, c in final.items()], rate("total_gold").alias("gold_per_min"), rate("net_cs").alias("cs_per_min"),
        "peak_gold_advantage", F.col("f.gold_diff").alias("final_gold_diff"),
    )


def load_batch(hub: DataFrame, satellite: DataFrame, staged: DataFrame) -> tuple[DataFrame, DataFrame, dict[str, DataFrame]]:
    """(new hub rows, new states, derived tables of the new states) from one staged batch.

    All targets read the same batch; the caller persists it, or writes each result before the next is read.
    """
    keys, states = new_hub_rows(hub, staged), new_states(satellite, staged)
    return keys, states, partitions(states, hub.unionByName(keys))
