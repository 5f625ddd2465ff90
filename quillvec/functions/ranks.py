"""Exact order statistics per group, without sorting a group in one task.

The values of a group are counted in coarse buckets with a hash aggregate, which combines before the shuffle.
The bucket that holds a wanted rank is found from the counts and divided again, until it is small or holds a
single value; only then are its values ordered. Buckets are closed ranges of actual values.

Ranks are 0-based SQL expressions of the number of values ``n_all``, by name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillvec.storage import BROADCAST_ROWS, checkpointed

LOG_STEPS = 256
LINEAR_STEPS = 4096
SORT_ROWS = 2_000_000

MEDIAN = {"mid_low": "(n_all - 1) DIV 2", "mid_high": "n_all DIV 2"}


def fraction(p: float) -> str:
    """Rank ``int(n * p)``, with the product taken in doubles."""
    return f"CAST(floor(CAST(n_all AS DOUBLE) * {p}D) AS BIGINT)"


def coarse_bucket(value: str) -> str:
    """A non-decreasing whole number of the value: steps of 0.4 % of its size."""
    return f"floor(signum({value}) * log1p(abs({value})) * {LOG_STEPS})"


def first_brackets(hist: DataFrame, keys: list[str], ranks: dict[str, str], *more: str) -> DataFrame:
    """For each key and rank: bounds and size of the bucket that holds it, and the rank inside; and ``more``.

    ``hist`` has ``n, lo, hi`` per key and ``bucket``. Both windows run over buckets, whose number is bounded.
    """
    by = ", ".join(keys)
    placed = hist.selectExpr(
        "*", f"sum(n) OVER (PARTITION BY {by}) AS n_all",
        f"coalesce(sum(n) OVER (PARTITION BY {by} ORDER BY bucket "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below")
    columns = []
    for name, rank in ranks.items():
        here = f"{rank} >= below AND {rank} < below + n"
        columns += [f"max(CASE WHEN {here} THEN {what} END) AS {column}_{name}"
                    for column, what in (("lo", "lo"), ("hi", "hi"), ("n", "n"), ("rank", f"{rank} - below"))]
    return placed.groupBy(*keys).agg(*map(F.expr, [*columns, *more]))


def _inside(name: str, value: str) -> str:
    return f"lo_{name} < hi_{name} AND {value} BETWEEN lo_{name} AND hi_{name}"


def _bracket_rows(values: DataFrame, keys: list[str], value: str, brackets: DataFrame, ranks: dict[str, str],
                  small: bool) -> DataFrame:
    """Values inside an open bracket, one row per bracket they fall in."""
    open_brackets = brackets.select(*keys, *[f"{c}_{r}" for r in ranks for c in ("lo", "hi", "rank")])
    if small:
        open_brackets = F.broadcast(open_brackets)
    found = ", ".join(f"CASE WHEN {_inside(r, value)} THEN "
                      f"struct('{r}' AS target, lo_{r} AS lo, hi_{r} AS hi, rank_{r} AS want) END" for r in ranks)
    return values.select(*keys, value).join(open_brackets, keys) \
        .filter(" OR ".join(f"({_inside(r, value)})" for r in ranks)) \
        .selectExpr(*keys, value, f"explode(array_compact(array({found}))) AS b").select(*keys, value, "b.*")


def resolve(values: DataFrame, keys: list[str], value: str, brackets: DataFrame, ranks: dict[str, str],
            carry: list[str], sort_rows: int = SORT_ROWS) -> DataFrame:
    """Values at the wanted ranks: ``keys``, ``carry`` and one column per rank. ``brackets`` must be checkpointed."""
    kept = [*keys, *carry]
    unit = [*keys, "target", "lo", "hi", "want"]
    before = None
    while True:
        sizes = ", ".join(f"CASE WHEN lo_{r} < hi_{r} THEN n_{r} END" for r in ranks)
        largest, groups = brackets.selectExpr(f"max(greatest({sizes}))", "count(*)").first()
        if largest is None:
            return brackets.selectExpr(*kept, *[f"lo_{r} AS {r}" for r in ranks])
        small = groups <= BROADCAST_ROWS // 4
        rows = _bracket_rows(values, keys, value, brackets, ranks, small)
        if largest <= sort_rows:
            break
        if before is not None and largest >= before:
            raise ValueError(f"a bracket of {largest} values can't be divided: {value} must be finite numbers")
        before = largest
        finer = rows.withColumn("step", F.expr(f"floor(({value} - lo) / (hi - lo) * {LINEAR_STEPS})")) \
            .groupBy(*unit, "step").agg(F.expr("count(*) AS n"), F.expr(f"min({value}) AS new_lo"),
                                        F.expr(f"max({value}) AS new_hi"))
        brackets = checkpointed(_narrowed(finer, keys, kept, brackets, ranks))
    place = f"row_number() OVER (PARTITION BY {', '.join(keys)}, target ORDER BY {value}) AS place"
    found = rows.selectExpr(*keys, "target", "want", value, place).filter("place = want + 1").groupBy(*keys) \
        .agg(*[F.expr(f"min(CASE WHEN target = '{r}' THEN {value} END) AS at_{r}") for r in ranks])
    return brackets.join(F.broadcast(found) if small else found, keys, "left").selectExpr(
        *kept, *[f"coalesce(at_{r}, lo_{r}) AS {r}" for r in ranks])


def _narrowed(finer: DataFrame, keys: list[str], kept: list[str], brackets: DataFrame,
              ranks: dict[str, str]) -> DataFrame:
    below = (f"coalesce(sum(n) OVER (PARTITION BY {', '.join(keys)}, target ORDER BY step "
             "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below")
    hit = finer.selectExpr("*", below).filter("want >= below AND want < below + n")
    columns = {"lo": "new_lo", "hi": "new_hi", "n": "n", "rank": "want - below"}
    wide = hit.groupBy(*keys).agg(*[
        F.expr(f"max(CASE WHEN target = '{r}' THEN {source} END) AS new_{name}_{r}")
        for r in ranks for name, source in columns.items()])
    return brackets.join(wide, keys, "left").selectExpr(
        *kept, *[f"coalesce(new_{name}_{r}, {name}_{r}) AS {name}_{r}" for r in ranks for name in columns])
