"""Lookup joins that survive keys holding a large share of the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key with this many rows is spread over several tasks. N rows have at most
# N / HOT_ROWS such keys, which bounds the broadcast: a million for 10^12 rows.
HOT_ROWS = 1_000_000
SALTS = 64
# Smaller settings than this would let the broadcast lists grow with the data.
LEAST_HOT_ROWS = 100_000


def checked_hot_rows(value: int | str) -> int:
    """A setting for hot rows that keeps the lists of hot keys short."""
    if int(value) < LEAST_HOT_ROWS:
        raise ValueError(f"hot rows must be {LEAST_HOT_ROWS} or more, so that few keys can be hot")
    return int(value)


def hot_keys(df: DataFrame, keys: list[str], min_rows: int = HOT_ROWS) -> DataFrame:
    """Keys with at least ``min_rows`` rows (counted map-side first, so a hot key is cheap).

    Operators that take ``min_rows`` as a setting hold it to ``checked_hot_rows`` first.
    """
    return df.groupBy(*keys).count().filter(F.col("count") >= min_rows).select(*keys)


def spread_join(
    fact: DataFrame,
    lookup: DataFrame,
    keys: list[str],
    hot: DataFrame,
    spread_by: list[str],
    how: str = "left",
    salts: int = SALTS,
) -> DataFrame:
    """``fact JOIN lookup`` on null-safe equality of ``keys``, hot keys salted.

    ``hot`` holds distinct keys and must come from ``hot_keys`` or a filter with
    the same bound. Rows of a hot key get a salt from ``spread_by`` (columns that
    tell the rows of one key apart), the lookup rows of a hot key are repeated
    once per salt; all other rows have salt 0. The result is that of the plain
    join whatever ``hot`` contains.
    """
    marked = F.broadcast(
        hot.select(*[F.col(k).alias(f"_hot_{k}") for k in keys], F.lit(True).alias("_hot"))
    )
    is_hot = _all_equal(keys, [f"_hot_{k}" for k in keys])
    spare = [f"_hot_{k}" for k in keys]
    salted = (
        fact.join(marked, is_hot, "left")
        .withColumn(
            "_salt",
            F.when(F.col("_hot"), F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int")).otherwise(0),
        )
        .drop("_hot", *spare)
    )
    repeated = (
        lookup.join(marked, is_hot, "left")
        .withColumn(
            "_lookup_salt",
            F.explode(
                F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
            ),
        )
        .drop("_hot", *spare)
        .withColumnsRenamed({k: f"_lookup_{k}" for k in keys})
    )
    condition = _all_equal([*keys, "_salt"], [*[f"_lookup_{k}" for k in keys], "_lookup_salt"])
    return salted.join(repeated, condition, how).drop(
        "_salt", "_lookup_salt", *[f"_lookup_{k}" for k in keys]
    )


def _all_equal(left: list[str], right: list[str]) -> Column:
    pairs = [F.col(a).eqNullSafe(F.col(b)) for a, b in zip(left, right, strict=True)]
    return reduce(lambda a, b: a & b, pairs)
