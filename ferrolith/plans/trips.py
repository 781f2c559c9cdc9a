"""Trip ranking: listings + forecasts → clean tables → best hotels and cities."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrolith.functions import numbers, text
from ferrolith.operators import charts, joins, ordering

# Limits of the ranking.
MAX_RAIN_MM = 5.0
MIN_RATING = 8.0


def clean_hotels(raw: DataFrame, accept_integers: bool = False) -> DataFrame:
    """Typed hotel table; rows without a position are dropped.

    A score without decimals counts as 0.0 unless ``accept_integers`` is set.
    """
    position = {c: numbers.as_number(F.col(c)) for c in ("latitude", "longitude")}
    return raw.select(
        F.col("nom_hotel").alias("name"), F.col("ville").alias("city"),
        text.first_decimal(F.col("score"), accept_integers).alias("rating"), F.col("prix").alias("price"),
        *[value.alias(name) for name, value in position.items()],
        F.col("url").alias("booking_url"), "description",
    ).dropna(subset=list(position))


def locate(hotels: DataFrame, places: DataFrame, cities: DataFrame) -> DataFrame:
    """Positions by hotel name and city, else by city; unmatched hotels are dropped."""
    found = joins.lookup_with_fallback(
        hotels, places, cities, ["nom_hotel", "ville"], ["ville"], ["latitude", "longitude"])
    return found.filter(F.col("match_level") != "none")


def city_table(hotels: DataFrame, city: str = "ville") -> DataFrame:
    """Mean position per city and a number in alphabetical order."""
    means = hotels.filter(F.col(city).isNotNull()).groupBy(city).agg(
        F.avg("latitude").alias("latitude"), F.avg("longitude").alias("longitude"))
    return ordering.sequential_ids(means, city, "city_id")


def forecast_rollup(forecasts: DataFrame, key: str = "city", blocks: str = "list", digits: bool = True) -> DataFrame:
    """Mean temperature, total rain, mean rain risk and score (temperature − 2 × rain) per city.

    A block without rain or risk counts as 0. Empty forecasts give no row.
    """
    block = forecasts.select(key, F.explode(blocks).alias("b")).select(
        key, F.col("b.main.temp").alias("temp"), F.coalesce("b.pop", F.lit(0.0)).alias("pop"),
        F.coalesce("b.rain.3h", F.lit(0.0)).alias("rain"))
    return roll_up_blocks(block, key, digits)


def roll_up_blocks(block: DataFrame, key: str, digits: bool = True) -> DataFrame:
    sums = block.groupBy(key).agg(
        F.avg("temp").alias("temperature_moyenne"), F.sum("rain").alias("pluie_totale_mm"),
        (F.avg("pop") * 100).alias("risque_pluie_pct"), (F.avg("temp") - F.sum("rain") * 2).alias("score_meteo"))
    if not digits:
        return sums
    return sums.withColumns({
        "temperature_moyenne": numbers.round_half_even(F.col("temperature_moyenne"), 1),
        "pluie_totale_mm": numbers.round_half_even(F.col("pluie_totale_mm"), 1),
        "risque_pluie_pct": numbers.round_half_even(F.col("risque_pluie_pct"), 0),
        "score_meteo": numbers.round_half_even(F.col("score_meteo"), 1)})


def best_hotels(hotels: DataFrame, weather: DataFrame) -> DataFrame:
    """Well rated hotels in dry cities, best first (ties by city and name)."""
    forecast = weather.select("ville", "temperature_moyenne", "pluie_totale_mm")
    where = (F.col("pluie_totale_mm") < MAX_RAIN_MM) & (F.col("rating") >= MIN_RATING)
    return joins.rank_join(hotels, forecast, "city", "ville", where, [F.desc("rating"), F.col("city"), F.col("name")])


def best_cities(ranked: DataFrame, n: int = 5) -> DataFrame:
    columns = ["rating", "temperature_moyenne", "latitude", "longitude"]
    return charts.map_points(ranked, "city", columns, "name", "rating", n)
