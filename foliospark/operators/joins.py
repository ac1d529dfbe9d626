"""Join helpers that hold up when one key has a third of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALTS = 16


def salted_join(many: DataFrame, few: DataFrame, keys: list[str], spread: Column, salts: int = SALTS, how: str = "inner") -> DataFrame:
    """Equi-join in which the rows of one key of ``many`` are spread over ``salts`` partitions by ``spread``, and the
    rows of ``few`` are repeated for each. for keys that are hot on the ``many`` side only. Never a broadcast, since the size of a written table says little about that of its rows. ``how`` may be inner or
    left_semi, left_anti or left, since every row of ``many`` meets all its partners in its own partition."""
    a = many.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    b = few.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return a.join(b.hint("merge"), [*keys, "_salt"], how).drop("_salt")


def grid_join(a: DataFrame, b: DataFrame, keys: list[str], spread_a: Column, spread_b: Column, side: int = 5) -> DataFrame:
    """Inner equi-join for keys that may be hot on both sides: each side is spread over ``side`` groups and repeated
    for the groups of the other, so that a hot key becomes ``side`` squared partitions."""
    all_ = F.explode(F.sequence(F.lit(0), F.lit(side - 1)))
    a = a.withColumn("_sa", F.pmod(F.xxhash64(spread_a), F.lit(side)).cast("int")).withColumn("_sb", all_)
    b = b.withColumn("_sb", F.pmod(F.xxhash64(spread_b), F.lit(side)).cast("int")).withColumn("_sa", all_)
    return a.join(b.hint("merge"), [*keys, "_sa", "_sb"]).drop("_sa", "_sb")
