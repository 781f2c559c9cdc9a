"""Catalogue queries. `part` stands in for games: brand = publisher, words of the name = genres."""

from pyspark.sql import functions as F

from ferrolith.catalog.registry import query
from ferrolith.functions import numbers, text
from ferrolith.operators import aggregates, joins
from ferrolith.plans import catalogue
from ferrolith.sources.tables import table

GAMES_SQL = """
sold AS (SELECT l_partkey, count(*) AS n, count(*) FILTER (WHERE l_returnflag = 'N') AS kept,
                max(l_shipdate) AS last_ship FROM lineitem GROUP BY 1),
raw AS (
  SELECT p_partkey AS app_id, p_name AS game_name, p_brand AS publisher, replace(p_name, ' ', ', ') AS genre,
         CASE WHEN p_partkey % 7 = 0 THEN NULL WHEN p_partkey % 11 = 0 THEN '0' WHEN p_partkey % 13 = 0 THEN 'n/a'
              ELSE CAST(CAST(floor(p_retailprice) AS INTEGER) * (p_size % 7 + 1) AS VARCHAR) END AS price,
         CASE WHEN p_size > 40 THEN '18' WHEN p_size > 35 THEN '16' WHEN p_size > 30 THEN '7'
              WHEN p_size > 10 THEN '0' ELSE NULL END AS required_age,
         CASE WHEN p_size % 3 = 0 THEN '10' ELSE '0' END AS discount,
         coalesce(kept, 0) AS positive, coalesce(n, 0) - coalesce(kept, 0) AS negative,
         strftime(last_ship, '%Y/%m/%-d') AS release_date, CAST(year(last_ship) AS INTEGER) AS release_year,
         p_type || ', <b>' || p_brand || '</b>,,' AS languages,
         p_size % 2 = 0 AS on_windows, p_size % 3 = 0 AS on_mac, p_size % 4 = 0 AS on_linux
  FROM part LEFT JOIN sold ON p_partkey = l_partkey),
games AS (
  SELECT *, TRY_CAST(price AS DOUBLE) AS price_cents, TRY_CAST(price AS DOUBLE) / 100 AS price_eur,
         price IS NULL OR coalesce(TRY_CAST(price AS DOUBLE) = 0, FALSE) AS is_free,
         TRY_CAST(required_age AS INTEGER) AS age, CAST(discount AS INTEGER) AS discount_pct,
         positive + negative AS total_ratings,
         CASE WHEN positive + negative > 0 THEN positive::DOUBLE / (positive + negative)::DOUBLE * 100 END AS ratio
  FROM raw),
genres AS (SELECT g.* EXCLUDE (genre), trim(u.genre) AS genre
           FROM games g, unnest(string_split(g.genre, ', ')) AS u(genre) WHERE trim(u.genre) <> '')
"""


def raw_games(spark, folder):
    """The part table shaped like the nested catalogue records."""
    sold = table(spark, folder, "lineitem").groupBy("l_partkey").agg(
        F.count("*").alias("n"), F.count_if(F.col("l_returnflag") == "N").alias("kept"),
        F.max("l_shipdate").alias("last_ship"))
    part = table(spark, folder, "part").join(sold, F.col("p_partkey") == F.col("l_partkey"), "left")
    key, size = F.col("p_partkey"), F.col("p_size")
    amount = (F.floor("p_retailprice").cast("int") * (size % 7 + 1)).cast("string")
    price = F.when(key % 7 == 0, None).when(key % 11 == 0, "0").when(key % 13 == 0, "n/a").otherwise(amount)
    age = F.when(size > 40, "18").when(size > 35, "16").when(size > 30, "7").when(size > 10, "0")
    kept, n = F.coalesce("kept", F.lit(0)), F.coalesce("n", F.lit(0))
    return part.select(F.struct(
        key.cast("string").alias("appid"), F.col("p_name").alias("name"), F.lit(None).cast("string").alias("developer"),
        F.col("p_brand").alias("publisher"), age.alias("required_age"), price.alias("price"),
        F.when(size % 3 == 0, "10").otherwise("0").alias("discount"),
        F.date_format("last_ship", "yyyy/MM/d").alias("release_date"),
        kept.cast("string").alias("positive"), (n - kept).cast("string").alias("negative"),
        F.struct((size % 2 == 0).alias("windows"), (size % 3 == 0).alias("mac"), (size % 4 == 0).alias("linux"))
        .alias("platforms"),
        F.replace("p_name", F.lit(" "), F.lit(", ")).alias("genre"),
        F.array("p_type").alias("categories"),
        F.concat("p_type", F.lit(", <b>"), "p_brand", F.lit("</b>,,")).alias("languages"),
    ).alias("data"))


def games(spark, folder):
    return catalogue.games(raw_games(spark, folder))


def genres(spark, folder):
    return catalogue.genres(games(spark, folder))


@query("flatten_nested", f"""
WITH {GAMES_SQL}
SELECT CAST(app_id AS INTEGER) AS app_id, game_name, publisher, price_cents, price_eur, is_free, age AS required_age,
       discount_pct, CAST(total_ratings AS INTEGER) AS total_ratings, release_year, on_linux FROM games
""")
def flatten_nested(spark, folder):
    return games(spark, folder).select(
        "app_id", "game_name", "publisher", "price_cents", "price_eur", "is_free", "required_age", "discount_pct",
        "total_ratings", "release_year", "on_linux")


@query("flatten_json_props", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
       CAST(json_extract_string(props, '$.k') AS DOUBLE) / 100 AS k_share,
       CAST(coalesce(json_extract_string(props, '$.absent'), '0') AS INTEGER) AS absent
FROM events
""")
def flatten_json_props(spark, folder):
    parsed = F.from_json("props", "k int, absent int")
    return table(spark, folder, "events").select("event_id", parsed.alias("p")).select(
        "event_id", F.col("p.k").alias("k"), (F.col("p.k") / 100.0).alias("k_share"),
        F.coalesce("p.absent", F.lit(0)).alias("absent"))


@query("group_count_desc", f"WITH {GAMES_SQL} SELECT publisher, count(*) AS nb_jeux FROM games GROUP BY 1")
def group_count_desc(spark, folder):
    return catalogue.publishers(games(spark, folder))


@query("topk_ratio", f"""
WITH {GAMES_SQL}
SELECT game_name, publisher, round(ratio, 2) AS positive_ratio, CAST(total_ratings AS INTEGER) AS total_ratings
FROM games WHERE total_ratings >= 35 ORDER BY round(ratio, 2) DESC, total_ratings DESC, game_name LIMIT 20
""")
def topk_ratio(spark, folder):
    return catalogue.best_rated(games(spark, folder), minimum=35)


@query("count_per_year", f"""
WITH {GAMES_SQL}
SELECT release_year, count(*) AS nb_sorties FROM games WHERE release_year >= 2000 GROUP BY 1
""")
def count_per_year(spark, folder):
    return catalogue.releases_per_year(games(spark, folder))


@query("describe_price", f"""
WITH {GAMES_SQL}
SELECT count(price_eur) AS count, round(avg(price_eur), 6) AS mean, round(stddev_samp(price_eur), 6) AS stddev,
       min(price_eur) AS min, max(price_eur) AS max FROM games WHERE NOT is_free
""")
def describe_price(spark, folder):
    return catalogue.REPORTS["paid_prices"].run(games(spark, folder)).withColumns(
        {c: F.round(c, 6) for c in ("mean", "stddev")})


@query("price_buckets", f"""
WITH {GAMES_SQL}
SELECT CASE WHEN price_eur = 0 THEN 'Gratuit' WHEN price_eur < 5 THEN '< 5 EUR' WHEN price_eur < 10 THEN '5 - 10 EUR'
            WHEN price_eur < 20 THEN '10 - 20 EUR' WHEN price_eur < 40 THEN '20 - 40 EUR'
            WHEN price_eur < 60 THEN '40 - 60 EUR' ELSE '60+ EUR' END AS price_range, count(*) AS nb_jeux
FROM games WHERE NOT is_free AND price_eur IS NOT NULL GROUP BY 1
""")
def price_buckets(spark, folder):
    return catalogue.price_buckets(games(spark, folder))


@query("discount_counts", f"""
WITH {GAMES_SQL}
SELECT count(*) AS total_jeux, count(*) FILTER (WHERE discount_pct > 0) AS avec_reduction,
       count(*) FILTER (WHERE is_free) AS gratuits FROM games
""")
def discount_counts(spark, folder):
    return catalogue.REPORTS["discounts"].run(games(spark, folder))


@query("explode_tokens", f"""
WITH {GAMES_SQL},
spoken AS (SELECT trim(u.l) AS language FROM games,
           unnest(string_split(regexp_replace(languages, '<[^>]+>', '', 'g'), ',')) AS u(l))
SELECT language, count(*) AS nb_jeux FROM spoken WHERE language <> '' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 25
""")
def explode_tokens(spark, folder):
    return catalogue.languages(games(spark, folder))


@query("age_groups", f"""
WITH {GAMES_SQL}
SELECT CASE WHEN age >= 18 THEN '18+' WHEN age >= 16 THEN '16+' WHEN age > 0 THEN 'Autre restriction'
            ELSE 'Tous publics / non renseigne' END AS age_group, count(*) AS nb_jeux FROM games GROUP BY 1
""")
def age_groups(spark, folder):
    return catalogue.age_groups(games(spark, folder))


@query("distinct_per_token", f"WITH {GAMES_SQL} SELECT genre, count(DISTINCT app_id) AS nb_jeux FROM genres GROUP BY 1")
def distinct_per_token(spark, folder):
    return catalogue.REPORTS["genres"].run(genres(spark, folder))


@query("having_avg_mix", f"""
WITH {GAMES_SQL}
SELECT genre, round(avg(round(ratio, 2)), 2) AS avg_positive_ratio, count(DISTINCT app_id) AS nb_jeux,
       round(avg(total_ratings), 0) AS avg_total_ratings
FROM genres WHERE total_ratings >= 5 GROUP BY 1 HAVING count(DISTINCT app_id) >= 20
""")
def having_avg_mix(spark, folder):
    return catalogue.REPORTS["genre_ratings"].with_settings(ratings=5).run(genres(spark, folder))


@query("top_n_semi_join", f"""
WITH {GAMES_SQL},
best AS (SELECT publisher FROM games GROUP BY 1 ORDER BY count(*) DESC, publisher LIMIT 10)
SELECT publisher, genre, count(DISTINCT app_id) AS nb_jeux FROM genres WHERE publisher IN (SELECT publisher FROM best)
GROUP BY 1, 2
""")
def top_n_semi_join(spark, folder):
    base = games(spark, folder)
    return catalogue.publisher_genres(base, catalogue.genres(base))


@query("lucrative_groups", f"""
WITH {GAMES_SQL}
SELECT genre, round(avg(price_eur), 2) AS prix_moyen_eur, count(DISTINCT app_id) AS nb_jeux,
       round(sum(price_eur), 2) AS revenus_potentiels_eur
FROM genres WHERE NOT is_free AND price_eur > 0 GROUP BY 1 HAVING count(DISTINCT app_id) >= 10
""")
def lucrative_groups(spark, folder):
    return catalogue.REPORTS["genre_revenue"].run(genres(spark, folder))


@query("platform_counts", f"""
WITH {GAMES_SQL}
SELECT count(*) FILTER (WHERE on_windows) AS windows, count(*) FILTER (WHERE on_mac) AS mac,
       count(*) FILTER (WHERE on_linux) AS linux,
       count(*) FILTER (WHERE on_windows AND on_mac AND on_linux) AS all_platforms, count(*) AS total_jeux FROM games
""")
def platform_counts(spark, folder):
    return catalogue.REPORTS["platforms"].run(games(spark, folder))


@query("availability_rate", f"""
WITH {GAMES_SQL}
SELECT genre, count(DISTINCT app_id) AS nb_jeux,
       round(count(*) FILTER (WHERE on_windows)::DOUBLE / count(DISTINCT app_id)::DOUBLE * 100, 1) AS pct_windows,
       round(count(*) FILTER (WHERE on_mac)::DOUBLE / count(DISTINCT app_id)::DOUBLE * 100, 1) AS pct_mac,
       round(count(*) FILTER (WHERE on_linux)::DOUBLE / count(DISTINCT app_id)::DOUBLE * 100, 1) AS pct_linux
FROM genres GROUP BY 1 HAVING count(DISTINCT app_id) >= 20
""")
def availability_rate(spark, folder):
    return catalogue.genre_platforms(genres(spark, folder))


@query("availability_both_rates", """
SELECT l_returnflag, count(DISTINCT l_orderkey) AS ids,
       count(*) FILTER (WHERE l_discount > 0.05)::DOUBLE / count(DISTINCT l_orderkey)::DOUBLE * 100 AS pct_cheap,
       count(DISTINCT CASE WHEN l_discount > 0.05 THEN l_orderkey END)::DOUBLE / count(DISTINCT l_orderkey)::DOUBLE * 100
         AS pct_ids_cheap
FROM lineitem GROUP BY 1
""")
def availability_both_rates(spark, folder):
    flags = {"cheap": F.col("l_discount") > 0.05}
    return aggregates.availability(table(spark, folder, "lineitem"), "l_returnflag", "l_orderkey", flags)


@query("kpi_row", f"""
WITH {GAMES_SQL}
SELECT count(*) AS total_jeux, count(DISTINCT publisher) AS nb_publishers, round(avg(price_eur), 2) AS prix_moyen_eur,
       round(avg(round(ratio, 2)), 2) AS ratio_positif_moyen_pct, count(*) FILTER (WHERE is_free) AS nb_jeux_gratuits,
       count(*) FILTER (WHERE on_linux) AS nb_jeux_linux FROM games
""")
def kpi_row(spark, folder):
    return catalogue.REPORTS["indicators"].run(games(spark, folder))


@query("two_key_count", """
SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY 1, 2
""")
def two_key_count(spark, folder):
    return aggregates.group_counts(table(spark, folder, "lineitem"), ["l_returnflag", "l_linestatus"])


@query("rank_in_group", """
SELECT p_brand, p_type, n, CAST(row_number() OVER (PARTITION BY p_brand ORDER BY n DESC, p_type) AS INTEGER) AS place
FROM (SELECT p_brand, p_type, count(*) AS n FROM part GROUP BY 1, 2)
QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY n DESC, p_type) <= 3
""")
def rank_in_group(spark, folder):
    from ferrolith.operators.selection import first_per_group

    counts = table(spark, folder, "part").groupBy("p_brand", "p_type").agg(F.count("*").alias("n"))
    return first_per_group(counts, ["p_brand"], [F.desc("n"), "p_type"], 3, "place")


@query("table_shape", """
SELECT count(*) AS rows, CAST(11 AS INTEGER) AS columns FROM lineitem
""")
def table_shape(spark, folder):
    return aggregates.table_shape(table(spark, folder, "lineitem"))


@query("try_cast_numbers", """
SELECT o_orderkey, TRY_CAST(split_part(o_orderpriority, '-', 1) AS INTEGER) AS level,
       TRY_CAST(split_part(o_orderpriority, '-', 2) AS DOUBLE) AS word_as_number FROM orders
""")
def try_cast_numbers(spark, folder):
    part = lambda i: F.split_part("o_orderpriority", F.lit("-"), F.lit(i))
    return table(spark, folder, "orders").select(
        "o_orderkey", numbers.as_number(part(1), "int").alias("level"),
        numbers.as_number(part(2)).alias("word_as_number"))


@query("search_contains", """
SELECT c_custkey, c_name, c_mktsegment FROM customer
WHERE contains(lower(c_name), '99') OR contains(lower(c_mktsegment), 'auto')
""")
def search_contains(spark, folder):
    people = table(spark, folder, "customer")
    hit = text.matches_search([F.col("c_name"), F.col("c_mktsegment")], "99") | text.matches_search(
        [F.col("c_mktsegment")], "AUTO")
    return people.filter(hit).select("c_custkey", "c_name", "c_mktsegment")


@query("top_k_tail", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20
""")
def top_k_tail(spark, folder):
    return table(spark, folder, "orders").select("o_orderkey", "o_totalprice").orderBy(
        F.desc("o_totalprice"), "o_orderkey").limit(20)


@query("missing_ids", """
WITH ids AS (SELECT DISTINCT l_orderkey + l_partkey * 3 AS id FROM lineitem)
SELECT CAST(r.range AS BIGINT) AS id FROM range(1, (SELECT max(id) FROM ids) + 1) AS r
WHERE r.range NOT IN (SELECT id FROM ids)
""")
def missing_ids(spark, folder):
    ids = table(spark, folder, "lineitem").select((F.col("l_orderkey") + F.col("l_partkey") * 3).alias("id")).distinct()
    return joins.missing_ids(ids, "id", block=4096)
