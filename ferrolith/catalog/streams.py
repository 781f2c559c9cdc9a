"""Streaming queries; their SQL twins are the batch results."""

from pyspark.sql import functions as F

from ferrolith.catalog.landing import RESIDENTS_SQL, as_reads, residents
from ferrolith.catalog.registry import query
from ferrolith.plans import access
from ferrolith.sources.tables import table, table_stream
from ferrolith.streaming import live


@query("stream_access", f"""
WITH {RESIDENTS_SQL} SELECT plate_number AS plaque, ts AS timestamp, decision AS resultat, normalized_plate FROM decided
""")
def stream_access(spark, folder):
    reads = as_reads(table_stream(spark, folder, "events"))
    return live.run_to_folder(live.access_decisions(reads, residents(table(spark, folder, "customer"))), "access")


@query("stream_dedup", "SELECT DISTINCT user_id, epoch_us(ts) // 300000000 AS slot FROM events")
def stream_dedup(spark, folder):
    reads = table_stream(spark, folder, "events").select("user_id", "ts")
    return live.run_to_folder(live.distinct_passages(reads, "user_id", "ts"), "passages").select("user_id", "slot")


@query("stream_hourly", """
SELECT date_trunc('hour', ts) AS hour_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events
WHERE date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE GROUP BY 1, 2
""")
def stream_hourly(spark, folder):
    hourly = live.hourly_counts(table_stream(spark, folder, "events"), "ts", "event_type", "value")
    return live.run_to_folder(hourly, "hourly").withColumn("total", F.round("total", 4))


@query("stream_late_alert", """
SELECT e.event_id, e.event_id - 7 AS previous_id, p.value AS prev_delay_filled, e.event_id % 60 AS gap
FROM events e JOIN events p ON p.event_id = e.event_id - 7 WHERE p.value > e.event_id % 60
""")
def stream_late_alert(spark, folder):
    shape = lambda df: df.select(
        "event_id", (F.col("event_id") - 7).alias("previous_id"), "value", (F.col("event_id") % 60).alias("gap"), "ts")
    arriving, ended = (shape(table_stream(spark, folder, "events")) for _ in range(2))
    alerts = live.late_alerts(arriving.drop("value"), ended, "event_id", "previous_id", "value", "gap", "ts").filter("is_problem")
    return live.run_to_folder(alerts, "alerts").select("event_id", "previous_id", "prev_delay_filled", "gap")


_PASSAGES = """
WITH steps AS (SELECT user_id, event_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events),
heads AS (SELECT *, before IS NULL OR ts - before > INTERVAL 5 MINUTE AS is_first FROM steps)
"""


@query("passages_by_gap", _PASSAGES + "SELECT user_id, event_id, ts FROM heads WHERE is_first")
def passages_by_gap(spark, folder):
    return access.passages(table(spark, folder, "events").select("user_id", "event_id", "ts"), "user_id", "ts", "event_id")


@query("stream_passages", _PASSAGES + """,
numbered AS (SELECT *, sum(is_first::INT) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM heads)
SELECT user_id, min(ts) AS first_seen, max(ts) AS last_seen, count(*) AS reads FROM numbered GROUP BY user_id, k
HAVING max(ts) + INTERVAL 5 MINUTE <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE
""")
def stream_passages(spark, folder):
    rows = live.run_to_folder(live.passages(table_stream(spark, folder, "events").select("user_id", "ts"), "user_id", "ts"), "sessions")
    return rows.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("first_seen", "last_seen")})


@query("stream_live_access", f"""
WITH {RESIDENTS_SQL},
steps AS (SELECT 'AB' || lpad(CAST(user_id * 12 AS VARCHAR), 9, '0') || 'CD' AS plaque, ts, event_id % 29 = 0 AS gone FROM events
  WHERE event_id % 29 = 0 OR event_id % 17 = 0),
seen AS (SELECT d.event_id, d.plate_number, d.ts, d.normalized_plate, any_value(d.nom) AS nom, any_value(d.acces) AS acces,
    coalesce(bool_or(s.gone), false) AS gone, count(s.ts) FILTER (NOT s.gone) % 2 = 1 AS turned
  FROM decided d LEFT JOIN steps s ON s.plaque = d.normalized_plate AND s.ts <= d.ts GROUP BY 1, 2, 3, 4)
SELECT event_id, plate_number AS plaque, ts AS timestamp, normalized_plate, CASE WHEN gone THEN NULL ELSE nom END AS resident_name,
  CASE WHEN NOT gone AND nom IS NOT NULL AND (acces = 'oui') <> turned THEN 'AUTHORISED' ELSE 'REFUSED' END AS resultat FROM seen
""")
def stream_live_access(spark, folder):
    """Registry rows arrive as additions of the year 1970; some events switch a resident's access or end it."""
    events = table_stream(spark, folder, "events")
    start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    added = residents(table_stream(spark, folder, "customer")).select(
        "plaque", "marque", "nom", "acces", F.lit("add").alias("op"), start.alias("timestamp"), F.lit(0).cast("long").alias("seq"))
    key, none = F.col("event_id"), F.lit(None).cast("string")
    plate = F.concat(F.lit("AB"), F.lpad((F.col("user_id") * 12).cast("string"), 9, "0"), F.lit("CD"))
    turned = events.filter((key % 29 == 0) | (key % 17 == 0)).select(
        plate.alias("plaque"), none.alias("marque"), none.alias("nom"), none.alias("acces"),
        F.when(key % 29 == 0, "delete").otherwise("toggle").alias("op"), F.col("ts").alias("timestamp"), key.alias("seq"))
    return live.run_to_folder(live.live_decisions(as_reads(events), added.unionByName(turned), "event_id", keep="40 days"), "live-access")
