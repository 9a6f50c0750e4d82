"""Key joins.  No broadcast hints: the planner broadcasts on measured size and otherwise sort-merges,
splitting hot partitions adaptively."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placeweave.session import pinned

KeyPair = str | tuple[str, str]


def _pairs(on: Sequence[KeyPair]) -> list[tuple[str, str]]:
    return [(k, k) if isinstance(k, str) else k for k in on]


def equi_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[KeyPair],
    how: str = "inner",
    missing_matches: bool = True,
) -> DataFrame:
    """Join on equal keys, missing matching missing unless told otherwise; left key names are kept."""
    pairs = _pairs(on)
    renamed = right.withColumnsRenamed({r: f"__right_{r}" for _, r in pairs})

    def equal(l: str, r: str) -> Column:
        a, b = left[f"`{l}`"], renamed[f"`__right_{r}`"]
        return a.eqNullSafe(b) if missing_matches else a == b

    condition = reduce(lambda x, y: x & y, [equal(l, r) for l, r in pairs])
    joined = left.join(renamed, condition, how)
    return joined.drop(*[f"__right_{r}" for _, r in pairs])


def hot_key_join(left: DataFrame, right: DataFrame, on: Sequence[str], spread: Sequence[str],
                 chunks: int = 1000, least: int = 10_000) -> DataFrame:
    """Inner join for a left side whose keys may hold any share of the rows and match many right rows.

    Splitting by bytes does not see how many rows a key will yield.  Keys with more than a ``chunks``-th
    of the rows (there are fewer than ``chunks`` of them) are cut into pieces of about that many rows, by
    a hash of the ``spread`` columns, and their right rows are repeated for each piece.
    """
    counts = left.groupBy(*on).agg(F.count(F.lit(1)).alias("__rows"))
    piece = F.greatest(counts.agg(F.sum("__rows").alias("n")).scalar() / chunks, F.lit(least))
    hot = F.broadcast(pinned(
        counts.filter(F.col("__rows") > piece).select(*on, F.ceil(F.col("__rows") / piece).alias("__pieces"))))
    cut = equi_join(left, hot, on, "left", missing_matches=False)
    cut = cut.withColumn("__piece", F.coalesce(F.pmod(F.xxhash64(*spread), F.col("__pieces")), F.lit(0)))
    repeated = equi_join(right, hot, on, "left", missing_matches=False)
    repeated = repeated.withColumn("__piece", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce(F.col("__pieces"), F.lit(1)) - 1)))
    return equi_join(
        cut.drop("__pieces"), repeated.drop("__pieces"), [*on, "__piece"], missing_matches=False).drop("__piece")


def natural_join(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Join on every column name the two sides share."""
    shared = [c for c in left.columns if c in right.columns]
    if not shared:
        raise ValueError("no shared column names")
    return equi_join(left, right, shared, how)


def present_in(left: DataFrame, right: DataFrame, on: Sequence[KeyPair]) -> DataFrame:
    """Rows of ``left`` whose key occurs in ``right``; no fan-out."""
    return equi_join(left, right.select(*{r for _, r in _pairs(on)}).distinct(), on, "left_semi")


def absent_from(left: DataFrame, right: DataFrame, on: Sequence[KeyPair]) -> DataFrame:
    return equi_join(left, right.select(*{r for _, r in _pairs(on)}).distinct(), on, "left_anti")


def many_to_one(left: DataFrame, right: DataFrame, on: Sequence[KeyPair]) -> DataFrame:
    """Left join that fails at run time when a left row would match several right rows.

    The right side is folded to one row per key first, so a fan-out cannot happen at all;
    only keys that are actually matched can raise.
    """
    pairs = _pairs(on)
    keys = [r for _, r in pairs]
    payload = [c for c in right.columns if c not in keys]
    folded = right.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.any_value(F.col(c)).alias(c) for c in payload],
    )
    joined = equi_join(left, folded, pairs, "left")
    message = F.concat(F.lit("many-to-one join: several right rows for key "),
                       F.concat_ws(", ", *[F.col(l).cast("string") for l, _ in pairs]))
    # In a condition on the rows, so that no later projection or count can drop it.
    return joined.filter(F.when(F.col("__rows") > 1, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))).drop("__rows")


def member_flag(df: DataFrame, column: str, values: DataFrame, values_column: str, flag: str) -> DataFrame:
    """``column in values``: always true or false, a missing key matching a missing value."""
    known = values.select(F.col(values_column).alias("__value")).distinct().withColumn("__member", F.lit(True))
    joined = df.join(known, F.col(column).eqNullSafe(F.col("__value")), "left")
    return joined.withColumn(flag, F.coalesce("__member", F.lit(False))).drop("__value", "__member")


def name_changes(old: DataFrame, new: DataFrame, keys: Sequence[str], name: str,
                 old_name: str, new_name: str) -> DataFrame:
    """Keys whose name differs between two vintages."""
    before = old.select(*keys, F.col(name).alias(old_name))
    after = new.select(*keys, F.col(name).alias(new_name))
    changed = equi_join(before.distinct(), after.distinct(), keys)
    return changed.filter(F.col(old_name) != F.col(new_name)).distinct()


def apply_name_changes(df: DataFrame, changes: DataFrame, scope: Sequence[str], name: str,
                       old_name: str, new_name: str) -> DataFrame:
    """Replace names that changed within ``scope``; a name with two successors yields both rows."""
    renames = changes.select(*scope, F.col(old_name).alias(name), F.col(new_name).alias("__good")).distinct()
    joined = equi_join(df, renames, [*scope, name], "left")
    return joined.withColumn(name, F.coalesce("__good", name)).drop("__good")
