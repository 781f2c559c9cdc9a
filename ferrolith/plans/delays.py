"""Late returns: pairs of consecutive rentals and the minimum-gap what-if."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ferrolith.functions import dates, numbers
from ferrolith.operators import joins, ordering

# The threshold grid of the report, in minutes.
THRESHOLDS = (0, 720, 30)


def pairs_from_history(events: DataFrame, entity: str, moment: str, row_id: str, delay: str) -> DataFrame:
    """Consecutive pairs when only a time order is known: gap in whole minutes to the previous row."""
    linked = ordering.previous_row(events, entity, moment, row_id, [delay])
    gap = dates.whole_minutes_between(F.col(moment), F.col(f"prev_{moment}"))
    pairs = linked.withColumn("gap", gap).filter(F.col("gap").isNotNull())
    return joins.with_problem_flag(pairs, F.col(f"prev_{delay}"), F.col("gap"))


def threshold_curves(pairs: DataFrame, rentals: DataFrame, group: str, narrow: str, gap: str,
                     thresholds: tuple[int, int, int] = THRESHOLDS) -> DataFrame:
    """Share of problems solved and of rentals affected for each threshold and scope.

    Scope ``all`` holds every row, scope ``narrow`` the rows whose ``group``
    has that value. Each pair is counted once, into the first threshold that
    solves it and the first that blocks it; the curves are running sums over
    that small table, so no row is multiplied by the grid.
    """
    low, high, step = thresholds
    slots = (high - low) // step + 1
    in_narrow = F.coalesce(F.col(group) == narrow, F.lit(False))

    def slot(value: Column) -> Column:
        return F.greatest(F.lit(0), F.ceil((value - low) / F.lit(float(step)))).cast("int")

    solved_at = F.when(F.col("is_problem"), slot(F.col("prev_delay_filled")))
    affected_at = F.greatest(F.lit(0), F.floor((F.col(gap) - low) / F.lit(float(step))) + 1).cast("int")
    cells = (
        pairs.select(in_narrow.alias("narrow"), solved_at.alias("solved_at"), affected_at.alias("affected_at"))
        .withColumns({c: F.when(F.col(c).isNotNull(), F.least(c, F.lit(slots))) for c in ("solved_at", "affected_at")})
        .groupBy("narrow", "solved_at", "affected_at").agg(F.count("*").alias("n"))
    )
    moves = cells.select(
        F.explode(_scopes(narrow)).alias("scope"), "n",
        F.explode(F.array(F.struct(F.lit("solved").alias("kind"), F.col("solved_at").alias("slot")),
                          F.struct(F.lit("affected").alias("kind"), F.col("affected_at").alias("slot")))).alias("move"),
    ).filter(F.col("move.slot").isNotNull())
    per_slot = moves.groupBy("scope", F.col("move.slot").alias("slot")).agg(
        F.sum(F.when(F.col("move.kind") == "solved", F.col("n"))).alias("solved"),
        F.sum(F.when(F.col("move.kind") == "affected", F.col("n"))).alias("affected"),
    )
    totals = (
        rentals.groupBy(in_narrow.alias("narrow")).agg(F.count("*").alias("n"))
        .select(F.explode(_scopes(narrow)).alias("scope"), "n")
        .groupBy("scope").agg(F.sum("n").alias("total_rentals"))
    )
    grid = totals.select("scope", "total_rentals", F.explode(F.sequence(F.lit(0), F.lit(slots))).alias("slot"))
    upto = W.partitionBy("scope").orderBy("slot").rowsBetween(W.unboundedPreceding, W.currentRow)
    whole = W.partitionBy("scope")
    curves = grid.join(per_slot, ["scope", "slot"], "left").select(
        "scope", "slot", "total_rentals",
        F.coalesce(F.sum("solved").over(upto), F.lit(0)).alias("solved"),
        F.coalesce(F.sum("affected").over(upto), F.lit(0)).alias("affected"),
        F.coalesce(F.sum("solved").over(whole), F.lit(0)).alias("problems"),
    )
    solved_pct = F.coalesce(numbers.percent(F.col("solved"), F.col("problems")), F.lit(0.0))
    return curves.filter(F.col("slot") < slots).select(
        (F.col("slot") * step + low).alias("threshold"), "scope", "total_rentals", "problems", "solved", "affected",
        solved_pct.alias("pct_problems_solved"),
        numbers.percent(F.col("affected"), F.col("total_rentals")).alias("pct_rentals_affected"),
    )


def _scopes(narrow: str) -> Column:
    return F.when(F.col("narrow"), F.array(F.lit("all"), F.lit(narrow))).otherwise(F.array(F.lit("all")))


def at_threshold(curves: DataFrame, threshold: int, scope: str) -> DataFrame:
    """The indicator row of one threshold and scope."""
    return curves.filter((F.col("threshold") == threshold) & (F.col("scope") == scope))


def late_share(rentals: DataFrame, state: str, delay: str, ended: str, by: Sequence[str] = ()) -> DataFrame:
    """Late and on-time shares; the denominator is every ended rental, also those without a delay."""
    counts = rentals.filter(F.col(state) == ended).groupBy(*by).agg(
        F.count("*").alias("ended"),
        F.count_if(F.col(delay) > 0).alias("late"),
        F.count_if(F.col(delay) <= 0).alias("on_time"),
    )
    return counts.withColumns({
        "late_pct": numbers.percent(F.col("late"), F.col("ended")),
        "on_time_pct": numbers.percent(F.col("on_time"), F.col("ended")),
    })
