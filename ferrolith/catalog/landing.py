"""Extraction, trip-ranking and access-control queries.

`pages` are landed result pages; suppliers stand in for hotels and nations for
cities; `events` stand in for plate reads and `customer` for residents.
"""

from pyspark.sql import functions as F

from ferrolith.catalog.registry import query
from ferrolith.functions import numbers, text
from ferrolith.operators import aggregates, joins, ordering, selection
from ferrolith.plans import access, images, trips
from ferrolith.sources import web
from ferrolith.sources.tables import table


@query("html_fields_fallback", r"""
SELECT page_id, nullif(regexp_extract(html, '<title[^>]*>([^<]*)</title>', 1), '') AS title,
       nullif(regexp_extract(html, '<a[^>]*href="([^"]*)"', 1), '') AS link,
       CASE WHEN contains(regexp_extract(html, '<a[^>]*href="([^"]*)"', 1), 'http') THEN regexp_extract(html, '<a[^>]*href="([^"]*)"', 1)
            ELSE 'https://www.example.com' || regexp_extract(html, '<a[^>]*href="([^"]*)"', 1) END AS full_url,
       coalesce(substr(trim(regexp_replace(regexp_replace(coalesce(
         nullif(regexp_extract(html, '(?s)<section id="description">(.*?)</section>', 1), ''),
         nullif(regexp_extract(html, '(?s)<article[^>]*>(.*?)</article>', 1), '')), '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g')), 1, 500) || '...',
         'Description introuvable (Bloqué ?)') AS description
FROM pages
""")
def html_fields_fallback(spark, folder):
    html = F.col("html")
    blocks = [r'(?s)<section id="description">(.*?)</section>', r"(?s)<article[^>]*>(.*?)</article>"]
    return table(spark, folder, "pages").select(
        "page_id", web.first_match(html, r"<title[^>]*>([^<]*)</title>").alias("title"), web.first_link(html).alias("link"),
        text.absolute_url(web.first_link(html), "https://www.example.com").alias("full_url"),
        web.description(html, blocks).alias("description"))


@query("clean_numeric_text", r"""
WITH t AS (SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 'Avec une note de ' || CAST(o_orderkey % 10 AS VARCHAR) || ',5'
                WHEN 1 THEN 'Note : ' || CAST(o_orderkey % 9 AS VARCHAR) || '.25' WHEN 2 THEN '9' WHEN 3 THEN NULL ELSE '120 €' END AS raw FROM orders)
SELECT o_orderkey, coalesce(CAST(replace(nullif(regexp_extract(raw, '([0-9]+[.,][0-9]+)', 1), ''), ',', '.') AS DOUBLE), 0.0) AS rating,
       coalesce(CAST(replace(nullif(regexp_extract(raw, '([0-9]+(?:[.,][0-9]+)?)', 1), ''), ',', '.') AS DOUBLE), 0.0) AS rating_any,
       coalesce(regexp_replace(raw, '[^0-9]', '', 'g'), '0') AS digits, coalesce(replace(raw, ',', '.'), '0') AS pointed FROM t
""")
def clean_numeric_text(spark, folder):
    key = F.col("o_orderkey")
    raw = (
        F.when(key % 5 == 0, F.concat(F.lit("Avec une note de "), (key % 10).cast("string"), F.lit(",5")))
        .when(key % 5 == 1, F.concat(F.lit("Note : "), (key % 9).cast("string"), F.lit(".25")))
        .when(key % 5 == 2, "9").when(key % 5 == 4, "120 €"))
    rows = table(spark, folder, "orders").select("o_orderkey", raw.alias("raw"))
    return rows.select(
        "o_orderkey", text.first_decimal(F.col("raw")).alias("rating"),
        text.first_decimal(F.col("raw"), accept_integers=True).alias("rating_any"),
        text.digits_only(F.col("raw")).alias("digits"), text.comma_to_point(F.col("raw")).alias("pointed"))


@query("first_n_per_group", """
SELECT o_custkey, o_orderkey, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS INTEGER) AS place FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) <= 5
""")
def first_n_per_group(spark, folder):
    firsts = selection.first_per_group(table(spark, folder, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"], 5)
    return firsts.select("o_custkey", "o_orderkey", "place")


@query("surrogate_ids", """
SELECT p_name, n, row_number() OVER (ORDER BY p_name) AS name_id FROM (SELECT p_name, count(*) AS n FROM part GROUP BY 1)
""")
def surrogate_ids(spark, folder):
    names = table(spark, folder, "part").groupBy("p_name").agg(F.count("*").alias("n"))
    return ordering.sequential_ids(names, "p_name", "name_id").select("p_name", "n", "name_id")


@query("lookup_with_fallback", """
WITH fine AS (SELECT p_brand, p_type, avg(p_retailprice) AS price FROM part WHERE p_size > 25 GROUP BY 1, 2 HAVING count(*) >= 8),
rough AS (SELECT p_brand, avg(p_retailprice) AS price FROM part WHERE p_brand <> 'Brand#7' GROUP BY 1)
SELECT p_partkey, round(coalesce(f.price, r.price), 6) AS price,
       CASE WHEN f.price IS NOT NULL THEN 'precise' WHEN r.price IS NOT NULL THEN 'coarse' ELSE 'none' END AS match_level
FROM part p LEFT JOIN fine f USING (p_brand, p_type) LEFT JOIN rough r USING (p_brand)
""")
def lookup_with_fallback(spark, folder):
    part = table(spark, folder, "part")
    fine = part.filter("p_size > 25").groupBy("p_brand", "p_type").agg(
        F.avg("p_retailprice").alias("price"), F.count("*").alias("n")).filter("n >= 8")
    rough = part.filter(F.col("p_brand") != "Brand#7").groupBy("p_brand").agg(F.avg("p_retailprice").alias("price"))
    found = joins.lookup_with_fallback(
        part.select("p_partkey", "p_brand", "p_type"), fine, rough, ["p_brand", "p_type"], ["p_brand"], ["price"])
    return found.select("p_partkey", F.round("price", 6).alias("price"), "match_level")


WEATHER_SQL = """
blocks AS (SELECT o_custkey % 25 AS city, (o_totalprice % 3000) / 100 AS temp,
                  CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE (o_orderkey % 100) / 100.0::DOUBLE END AS pop,
                  CASE WHEN o_orderkey % 7 = 0 THEN (o_orderkey % 11) / 200.0::DOUBLE ELSE NULL END AS rain FROM orders),
weather AS (SELECT city, avg(temp) AS temperature_moyenne, sum(coalesce(rain, 0)) AS pluie_totale_mm,
                   avg(coalesce(pop, 0)) * 100 AS risque_pluie_pct, avg(temp) - 2 * sum(coalesce(rain, 0)) AS score_meteo FROM blocks GROUP BY 1)
"""


def weather(spark, folder):
    key = F.col("o_orderkey")
    block = F.struct(
        F.struct(((F.col("o_totalprice") % 3000) / 100).alias("temp")).alias("main"),
        F.when(key % 3 != 0, (key % 100) / 100.0).alias("pop"),
        F.when(key % 7 == 0, F.struct(((key % 11) / 200.0).alias("3h"))).alias("rain"))
    forecasts = table(spark, folder, "orders").select((F.col("o_custkey") % 25).alias("city"), F.array(block).alias("list"))
    return trips.forecast_rollup(forecasts, digits=False)


@query("forecast_rollup", f"""
WITH {WEATHER_SQL}
SELECT city, round(temperature_moyenne, 6) AS temperature_moyenne, round(pluie_totale_mm, 6) AS pluie_totale_mm,
       round(risque_pluie_pct, 6) AS risque_pluie_pct, round(score_meteo, 6) AS score_meteo FROM weather
""")
def forecast_rollup(spark, folder):
    return weather(spark, folder).withColumns({
        c: F.round(c, 6) for c in ("temperature_moyenne", "pluie_totale_mm", "risque_pluie_pct", "score_meteo")})


HOTELS_SQL = f"""
{WEATHER_SQL},
hotels AS (SELECT s_name AS name, s_nationkey AS city, (s_suppkey * 13 % 41) / 10.0::DOUBLE + 6 AS rating,
                  s_acctbal / 1000 AS latitude, s_acctbal / 500 AS longitude FROM supplier),
lim AS (SELECT median(pluie_totale_mm) AS m FROM weather),
ranked AS (SELECT h.*, w.temperature_moyenne, w.pluie_totale_mm / (SELECT m FROM lim) * 5 AS pluie_totale_mm
           FROM hotels h JOIN weather w ON h.city = w.city
           WHERE w.pluie_totale_mm / (SELECT m FROM lim) * 5 < 5 AND rating >= 8.0)
"""


def ranked_hotels(spark, folder):
    hotels = table(spark, folder, "supplier").select(
        F.col("s_name").alias("name"), F.col("s_nationkey").alias("city"),
        ((F.col("s_suppkey") * 13 % 41) / 10.0 + 6).alias("rating"),
        (F.col("s_acctbal") / 1000).alias("latitude"), (F.col("s_acctbal") / 500).alias("longitude"))
    city_weather = weather(spark, folder)
    middle = ordering.exact_median(city_weather, "pluie_totale_mm").scalar()
    scaled = city_weather.withColumnRenamed("city", "ville").withColumn(
        "pluie_totale_mm", F.col("pluie_totale_mm") / middle * 5)
    return trips.best_hotels(hotels, scaled)


@query("rank_join_filter", f"""
WITH {HOTELS_SQL} SELECT name, city, rating, round(temperature_moyenne, 6) AS temperature_moyenne FROM ranked
""")
def rank_join_filter(spark, folder):
    return ranked_hotels(spark, folder).select(
        "name", "city", "rating", F.round("temperature_moyenne", 6).alias("temperature_moyenne"))


@query("top_groups_after_join", f"""
WITH {HOTELS_SQL}
SELECT city, round(avg(rating), 9) AS rating, round(avg(latitude), 9) AS latitude, round(avg(longitude), 9) AS longitude,
       round(avg(temperature_moyenne), 9) AS temperature_moyenne, count(name) AS n
FROM ranked GROUP BY 1 ORDER BY avg(rating) DESC, city LIMIT 5
""")
def top_groups_after_join(spark, folder):
    best = trips.best_cities(ranked_hotels(spark, folder))
    return best.withColumns({c: F.round(c, 9) for c in ("rating", "latitude", "longitude", "temperature_moyenne")})


@query("top_hotels", f"""
WITH {HOTELS_SQL} SELECT name, city, rating FROM ranked ORDER BY rating DESC, city, name LIMIT 20
""")
def top_hotels(spark, folder):
    return ranked_hotels(spark, folder).select("name", "city", "rating").limit(20)


RESIDENTS_SQL = """
residents AS (SELECT 'AB' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') || 'CD' AS plaque, c_mktsegment AS marque, c_name AS nom,
                     CASE WHEN c_acctbal > 3000 THEN 'oui' ELSE 'non' END AS acces,
                     CASE WHEN c_nationkey > 12 THEN 'oui' ELSE 'non' END AS abonnement FROM customer),
reads AS (SELECT event_id, ts, value / 100 AS conf,
                 CASE event_id % 3 WHEN 0 THEN 'ab-' || lpad(CAST(user_id * 12 AS VARCHAR), 9, '0') || '-cd'
                      WHEN 1 THEN 'AB ' || lpad(CAST(user_id * 12 AS VARCHAR), 9, '0') || ' CD' ELSE '' END AS plate_number,
                 CASE WHEN event_id % 4 = 0 THEN NULL WHEN event_id % 2 = 0 THEN 'BUILDING' ELSE 'machinery' END AS brand FROM events),
decided AS (SELECT r.*, regexp_replace(upper(plate_number), '[^A-Z0-9]', '', 'g') AS normalized_plate, marque, nom, acces,
                   CASE WHEN acces = 'oui' THEN 'AUTHORISED' ELSE 'REFUSED' END AS decision
            FROM reads r LEFT JOIN residents ON plaque = regexp_replace(upper(plate_number), '[^A-Z0-9]', '', 'g')
            WHERE conf >= 0.5 AND plate_number <> '')
"""


def residents(customers):
    return customers.select(
        F.concat(F.lit("AB"), F.lpad(F.col("c_custkey").cast("string"), 9, "0"), F.lit("CD")).alias("plaque"),
        F.col("c_mktsegment").alias("marque"), F.col("c_name").alias("nom"),
        F.when(F.col("c_acctbal") > 3000, "oui").otherwise("non").alias("acces"),
        F.when(F.col("c_nationkey") > 12, "oui").otherwise("non").alias("abonnement"))


def as_reads(events):
    number = F.lpad((F.col("user_id") * 12).cast("string"), 9, "0")
    key = F.col("event_id")
    plate = F.when(key % 3 == 0, F.concat(F.lit("ab-"), number, F.lit("-cd"))).when(
        key % 3 == 1, F.concat(F.lit("AB "), number, F.lit(" CD"))).otherwise("")
    brand = F.when(key % 4 == 0, None).when(key % 2 == 0, "BUILDING").otherwise("machinery")
    return events.select(
        "event_id", F.col("ts").alias("timestamp"), (F.col("value") / 100).alias("detection_confidence"),
        plate.alias("plate_number"), brand.alias("brand"))


def decided(spark, folder):
    return access.decide(as_reads(table(spark, folder, "events")), residents(table(spark, folder, "customer")))


@query("plate_normalize", r"""
SELECT c_custkey, regexp_replace(upper(c_name || '-ab 12_cd'), '[^A-Z0-9]', '', 'g') AS plate,
       regexp_replace(upper(c_name || '-ab 12_cd'), '[ -]', '', 'g') AS ocr FROM customer
""")
def plate_normalize(spark, folder):
    raw = F.concat("c_name", F.lit("-ab 12_cd"))
    return table(spark, folder, "customer").select(
        "c_custkey", text.plate_key(raw).alias("plate"), text.ocr_plate(raw).alias("ocr"))


@query("access_decision", f"WITH {RESIDENTS_SQL} SELECT event_id, normalized_plate, nom AS resident_name, decision FROM decided")
def access_decision(spark, folder):
    return decided(spark, folder).select("event_id", "normalized_plate", "resident_name", "decision")


@query("brand_mismatch", f"""
WITH {RESIDENTS_SQL}
SELECT event_id, brand, marque AS expected_brand, 'open' AS status FROM decided WHERE upper(trim(brand)) <> upper(trim(marque))
""")
def brand_mismatch(spark, folder):
    return access.brand_mismatches(decided(spark, folder)).select("event_id", "brand", "expected_brand", "status")


@query("audit_log", f"""
WITH {RESIDENTS_SQL}
SELECT plate_number AS plaque, ts AS timestamp, decision AS resultat, normalized_plate FROM decided
ORDER BY ts DESC, normalized_plate LIMIT 50
""")
def audit_log(spark, folder):
    return access.latest(access.audit_log(decided(spark, folder)), 50)


@query("plate_history", f"""
WITH {RESIDENTS_SQL}
SELECT plate_number AS plaque, ts AS timestamp, decision AS resultat, normalized_plate FROM decided WHERE normalized_plate = 'AB000000012CD'
""")
def plate_history(spark, folder):
    return access.history(access.audit_log(decided(spark, folder)), "ab 000000012 cd")


@query("resident_kpis", f"""
WITH {RESIDENTS_SQL}
SELECT count(*) AS total, count(*) FILTER (WHERE acces = 'oui') AS active, count(*) FILTER (WHERE acces <> 'oui') AS blocked,
       count(*) FILTER (WHERE abonnement = 'oui') AS subscribers FROM residents
""")
def resident_kpis(spark, folder):
    return access.resident_indicators(residents(table(spark, folder, "customer")))


@query("resident_snapshot", f"""
WITH {RESIDENTS_SQL}, base AS (SELECT *, CAST(substr(plaque, 3, 9) AS BIGINT) AS k FROM residents)
SELECT plaque, marque, nom, CASE WHEN k % 5 = 1 THEN (CASE WHEN acces = 'oui' THEN 'non' ELSE 'oui' END) ELSE acces END AS acces, abonnement
FROM base WHERE k % 5 <> 0
UNION ALL SELECT 'ZZ' || CAST(n_nationkey AS VARCHAR), n_name, 'new', 'oui', 'non' FROM nation
""")
def resident_snapshot(spark, folder):
    base = residents(table(spark, folder, "customer"))
    number = F.substring("plaque", 3, 9).cast("bigint")
    old = base.withColumn("op", F.when(number % 5 == 0, "delete").when(number % 5 == 1, "toggle").otherwise("add"))
    new = table(spark, folder, "nation").select(
        F.concat(F.lit("ZZ"), F.col("n_nationkey").cast("string")).alias("plaque"), F.col("n_name").alias("marque"),
        F.lit("new").alias("nom"), F.lit("oui").alias("acces"), F.lit("non").alias("abonnement"), F.lit("add").alias("op"))
    changes = old.withColumn("seq", number).unionByName(new.withColumn("seq", F.lit(0).cast("bigint")))
    return access.apply_changes(base, changes)


@query("resident_search", f"""
WITH {RESIDENTS_SQL} SELECT plaque, nom, acces FROM residents WHERE contains(lower(plaque), 'b00000001') OR contains(lower(nom), '0777')
""")
def resident_search(spark, folder):
    rows = residents(table(spark, folder, "customer"))
    hit = text.matches_search([F.col("plaque")], "B00000001") | text.matches_search([F.col("nom")], "0777")
    return rows.filter(hit).select("plaque", "nom", "acces")


@query("one_read_per_passage", """
SELECT user_id, event_id, ts FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, epoch_us(ts) // 300000000 ORDER BY ts, event_id) = 1
""")
def one_read_per_passage(spark, folder):
    reads = table(spark, folder, "events").select("user_id", "event_id", "ts")
    return access.one_read_per_passage(reads, "user_id", "ts", "event_id", 5)


@query("detection_summary", """
WITH h AS (SELECT user_id AS f, count(*) AS hits FROM events WHERE value > 200 GROUP BY 1), f AS (SELECT DISTINCT user_id AS f FROM events)
SELECT count(*) AS files, count(hits) AS files_with_hits, CAST(coalesce(sum(hits), 0) AS BIGINT) AS hits,
       count(hits)::DOUBLE / count(*)::DOUBLE * 100 AS detection_rate, coalesce(sum(hits), 0)::DOUBLE / count(*)::DOUBLE AS hits_per_file
FROM f LEFT JOIN h USING (f)
""")
def detection_summary(spark, folder):
    events = table(spark, folder, "events")
    return aggregates.hit_summary(events.select("user_id").distinct(), events.filter("value > 200"), "user_id")


@query("latency_fps", """
SELECT event_type, round(avg(value / 1000), 9) AS mean_seconds, round(1 / avg(value / 1000), 6) AS per_second FROM events GROUP BY 1
""")
def latency_fps(spark, folder):
    timed = table(spark, folder, "events").withColumn("seconds", F.col("value") / 1000)
    return aggregates.latency_summary(timed, "seconds", ["event_type"]).withColumns(
        {"mean_seconds": F.round("mean_seconds", 9), "per_second": F.round("per_second", 6)})


@query("brightness_classes", """
SELECT CASE WHEN value < 60 THEN 'Nuit/Très sombre' WHEN value < 100 THEN 'Faible luminosité' WHEN value < 150 THEN 'Luminosité moyenne'
            ELSE 'Jour/Bien éclairé' END AS light, count(*) AS n FROM events GROUP BY 1
""")
def brightness_classes(spark, folder):
    return table(spark, folder, "events").groupBy(images.light_class(F.col("value")).alias("light")).agg(F.count("*").alias("n"))


@query("box_geometry", """
SELECT l_orderkey, l_partkey, l_linenumber, l_discount * l_tax AS area, CASE WHEN l_tax > 0 THEN l_discount / l_tax ELSE 0.0 END AS ratio FROM lineitem
""")
def box_geometry(spark, folder):
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", numbers.box_area(F.col("l_discount"), F.col("l_tax")).alias("area"),
        numbers.box_ratio(F.col("l_discount"), F.col("l_tax")).alias("ratio"))


@query("correction_feed", """
SELECT page_id, label, x2 - x1 AS box_width FROM (
  SELECT page_id, CASE WHEN page_id % 3 = 0 THEN 'brand' || CAST(page_id % 5 AS VARCHAR) END AS label,
         CAST(page_id % 10 AS DOUBLE) AS x1, CAST(page_id % 10 + length(url) AS DOUBLE) AS x2 FROM pages) WHERE label IS NOT NULL
""")
def correction_feed(spark, folder):
    key = F.col("page_id")
    rows = table(spark, folder, "pages").select(
        key.cast("string").alias("image_path"),
        F.when(key % 3 == 0, F.concat(F.lit("brand"), (key % 5).cast("string"))).alias("corrected_brand"),
        F.to_json(F.struct((key % 10).alias("x1"), F.lit(0).alias("y1"), (key % 10 + F.length("url")).alias("x2"),
                           F.lit(1).alias("y2"))).alias("box_json"),
        F.col("url").alias("plaque"), F.lit("2024-01-01").cast("timestamp").alias("timestamp"))
    feed = access.correction_feed(rows)
    return feed.select(F.col("image_path").cast("bigint").alias("page_id"), "label", (F.col("box.x2") - F.col("box.x1")).alias("box_width"))
