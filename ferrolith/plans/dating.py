"""Speed-dating study: cleaning, preferences, decisions, self-image and order effect."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrolith.functions import numbers
from ferrolith.operators import aggregates, selection

# Code tables and bins of the study (two label sets for the goal).
GOALS_CLEANING = {
    1: "Seamused a fun night out", 2: "Meet new people", 3: "Get a date",
    4: "Looking for a serious relationship", 5: "To say I did it", 6: "Other",
}
GOALS_STUDY = {
    1: "Rencontres amicales", 2: "Amusement", 3: "Mise en couple", 4: "Un soir", 5: "Expérience", 6: "Autre",
}
GENDERS = {0: "Femmes", 1: "Hommes"}
RATINGS = ("attr", "sinc", "intel", "fun", "amb", "shar")
INTEREST_EDGES = (-1.0, -0.33, 0.33, 1.0)
INTEREST_LABELS = ("Faible", "Moyenne", "Forte")


def clean(meetings: DataFrame, goals: Mapping[int, str] = GOALS_CLEANING) -> DataFrame:
    """Drop waves 6 to 9 (another rating scale) and meetings without a decision; label the goal."""
    kept = selection.exclusion_band(meetings, "wave", 5, 10).dropna(subset=["dec", "dec_o"])
    return kept.withColumn("goal_desc", numbers.code_label(F.col("goal"), goals))


def people(meetings: DataFrame, order: Sequence[str]) -> DataFrame:
    """The first row of each person."""
    return selection.first_row(meetings, ["iid"], order)


def preference_means(df: DataFrame, columns: Sequence[str], group: str) -> DataFrame:
    """Mean of each preference per group, long; rows lacking any preference are dropped."""
    complete = aggregates.present(df, [group, *columns])
    return aggregates.means(complete, columns, [group]).unpivot([group], list(columns), "attribute", "importance")


def rating_correlations(df: DataFrame, ratings: Sequence[str], decision: str, group: str,
                        groups: Sequence) -> DataFrame:
    """One row per rating, one column per group."""
    long = aggregates.target_correlations(df, ratings, decision, group)
    return long.groupBy("column").pivot(group, list(groups)).agg(F.first("corr"))


def rate_by_interest(df: DataFrame, value: str, decision: str) -> DataFrame:
    """Mean decision per interest bin."""
    label = numbers.right_closed_bin(F.col(value), INTEREST_EDGES, INTEREST_LABELS)
    binned = aggregates.present(df.withColumn("interest", label), ["interest", decision])
    return binned.groupBy("interest").agg(F.avg(decision).alias("rate"), F.count("*").alias("n"))


def rate_by(df: DataFrame, key: str, decision: str) -> DataFrame:
    rows = aggregates.present(df, [key, decision])
    return rows.groupBy(key).agg(F.avg(decision).alias("rate"))


def self_image(meetings: DataFrame, person: str, group: str, own: str, received: str) -> DataFrame:
    """Own rating against the average rating received."""
    own_side = meetings.select(person, group, own).distinct()
    others = meetings.groupBy(person).agg(F.avg(received).alias(received))
    return own_side.join(others, person).dropna()
