"""Left lookups that hold up when one key owns a large share of the rows."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from depotstar.session import estimated_bytes, shuffles_freed, source_bytes

# Below this size one task can take all rows of one key.
SKEW_FLOOR = 1 << 30
# A key is hot from this share of the rows on, so there are at most 1 / HOT_SHARE hot keys.
HOT_SHARE = 0.002
# Tasks among which the rows of one hot key are spread.
SALTS = 64
# Words of 64 bits in the filter of keys that `sifted` broadcasts.
FILTER_WORDS = 1 << 20

_SALT = "_salt"
_MAY = "_may"


def broadcast_limit(df: DataFrame) -> int:
    """The session's own limit for a broadcast side, in bytes; -1 means never."""
    text = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold").strip().lower()
    text = text.removesuffix("b")
    units = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}
    if text and text[-1] in units:
        return int(text[:-1]) * units[text[-1]]
    return int(text)


def hot_keys(df: DataFrame, keys: list[str], share: float = HOT_SHARE) -> list[tuple]:
    """Keys, NULL ones included, that own more than `share` of a 1 % sample of the rows.

    The list only steers where rows go, never which rows match, so a sample is enough. It is read
    once: its size is observed while its keys are counted. No more than 1 / share keys can own so
    much, so that many of the most frequent ones, picked out by the tasks, hold them all.
    """
    size = Observation()
    # A fixed seed keeps the plan, and so any retry, the same.
    sample = df.select(*keys).sample(fraction=0.01, seed=17)
    seen = sample.observe(size, F.count(F.lit(1)).alias("rows"))
    counts = seen.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    with shuffles_freed(df.sparkSession):
        most = counts.orderBy(F.desc("_n")).limit(int(1 / share)).collect()
    least = max((size.get["rows"] if most else 0) * share, 1)
    return [tuple(r[k] for k in keys) for r in most if r["_n"] > least]


def left_lookup(
    left: DataFrame,
    right: DataFrame,
    on: dict[str, str],
    null_safe: bool = False,
    keys_from: DataFrame | None = None,
    floor: int | None = None,
    salts: int = SALTS,
    broadcast: bool = True,
) -> DataFrame:
    """Left join on `on` (left column -> right column); the right key columns are dropped.

    A right side under the session's broadcast limit is left to Spark, which then moves no left row;
    `broadcast=False` spreads hot keys there, too.
    Otherwise, if the left side is large and has hot keys, their rows are spread over `salts` tasks
    and only the right rows of those keys are repeated. The result is that of the plain join.

    Hot keys are looked for in `keys_from`, if given: the table that brought the key columns into
    `left`, so that the joins made since need not run for it.
    """
    floor = SKEW_FLOOR if floor is None else floor
    keys = [f"_k{i}" for i in range(len(on))]
    names = dict(zip(on.values(), keys))
    right = right.select([F.col(f"`{c}`").alias(names.get(c, c)) for c in right.columns])

    def matches(l: DataFrame, r: DataFrame) -> Column:
        pairs = [
            l[a].eqNullSafe(r[b]) if null_safe else l[a] == r[b] for a, b in zip(on, keys)
        ]
        return reduce(and_, pairs)

    plain = left.join(right, matches(left, right), "left").drop(*keys)
    source = left if keys_from is None else keys_from
    small = broadcast and estimated_bytes(right) <= broadcast_limit(left)
    if source_bytes(source) < floor or small:
        return plain
    hot = hot_keys(source, list(on))
    if not hot:
        return plain

    spread = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in left.columns]), F.lit(salts)).cast("int")
    copies = F.when(
        _is_one_of([F.col(k) for k in keys], hot), F.sequence(F.lit(0), F.lit(salts - 1))
    ).otherwise(F.array(F.lit(0)))
    l = left.withColumn(
        _SALT, F.when(_is_one_of([F.col(c) for c in on], hot), spread).otherwise(F.lit(0))
    )
    r = right.withColumn("_copy", F.explode(copies))
    joined = l.join(r, matches(l, r) & (l[_SALT] == r["_copy"]), "left")
    return joined.drop(*keys, _SALT, "_copy")


def _is_one_of(columns: list[Column], keys: list[tuple]) -> Column:
    """Whether the columns hold one of the listed keys; NULL equals NULL here."""
    whole = [k for k in keys if None not in k]
    if len(columns) == 1:
        test = columns[0].isin([k[0] for k in whole])
    else:
        test = F.struct(*columns).isin([F.struct(*map(F.lit, k)) for k in whole])
    tests = [F.coalesce(test, F.lit(False))] if whole else []
    tests += [
        reduce(and_, [c.eqNullSafe(F.lit(v)) for c, v in zip(columns, k)])
        for k in keys
        if None in k
    ]
    return reduce(or_, tests)


def matching(
    left: DataFrame,
    right: DataFrame,
    on: dict[str, str],
    negate: bool = False,
    null_safe: bool = False,
    keys_from: DataFrame | None = None,
    floor: int | None = None,
) -> DataFrame:
    """Left rows whose key is among the right ones, or with `negate` those whose key is not."""
    found = right.select(*on.values()).distinct().withColumn("_found", F.lit(True))
    marked = left_lookup(left, found, on, null_safe, keys_from, floor)
    kept = F.col("_found").isNull() if negate else F.col("_found").isNotNull()
    return marked.where(kept).drop("_found")


def may_match(
    left: DataFrame, right: DataFrame, on: dict[str, str], name: str, words: int = FILTER_WORDS
) -> DataFrame:
    """`left` with a column `name`, false only where the key is surely not among the right ones.

    The right keys set one bit each in a filter of at most `words` rows, which is broadcast; so no row
    of `left` moves, however many there are. NULL is a key like any other here. Keys whose types differ
    on the two sides are not told apart, since equal values of unlike types have unlike hashes.
    """
    types = [[f.dataType for f in df.select(*[F.col(f"`{c}`") for c in cs]).schema] for df, cs in ((left, on), (right, on.values()))]
    if types[0] != types[1]:
        return left.withColumn(name, F.lit(True))

    def place(columns: list[str]) -> tuple[Column, Column]:
        digest = F.xxhash64(*[F.col(f"`{c}`") for c in columns])
        bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.shiftrightunsigned(digest, 58).cast("int"))
        return F.pmod(digest, F.lit(words)), bit

    word, bit = place(list(on.values()))
    bits = right.select(word.alias("_word"), bit.alias("_bit")).groupBy("_word").agg(F.bit_or("_bit").alias("_bits"))
    word, bit = place(list(on))
    met = left.join(F.broadcast(bits), word == F.col("_word"), "left")
    may = F.coalesce(F.col("_bits").bitwiseAND(bit) != 0, F.lit(False))
    return met.select(*[F.col(f"`{c}`") for c in left.columns], may.alias(name))


def sifted(
    left: DataFrame,
    right: DataFrame,
    on: dict[str, str],
    negate: bool = False,
    null_safe: bool = False,
) -> DataFrame:
    """As `matching`, for few right keys beside a large left side.

    Only the left rows that pass a filter of the right keys are shuffled.
    """
    unmet, met = parted(left, right, on)
    found = matching(met, right, on, negate, null_safe, keys_from=left)
    return unmet.unionByName(found) if negate else found


def parted(left: DataFrame, right: DataFrame, on: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """The left rows whose key is surely not among the right ones, and those whose key may be."""
    marked = may_match(left, right, on, _MAY)
    return marked.where(~F.col(_MAY)).drop(_MAY), marked.where(_MAY).drop(_MAY)
