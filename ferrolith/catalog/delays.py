"""Delay queries. `events` stands in for rentals: user = car, value = delay in minutes."""

from pyspark.sql import functions as F

from ferrolith.catalog.registry import query
from ferrolith.functions import dates
from ferrolith.operators import joins, ordering
from ferrolith.plans import delays
from ferrolith.sources.tables import table

PAIRS_SQL = """
linked AS (
  SELECT event_id, ts, user_id, event_type, value,
         lag(value) OVER w AS prev_value, lag(ts) OVER w AS prev_ts
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
pairs AS (
  SELECT *, CAST(date_diff('microsecond', prev_ts, ts) // 60000000 AS BIGINT) AS gap,
         coalesce(prev_value, 0.0) AS prev_delay_filled
  FROM linked WHERE prev_ts IS NOT NULL)
"""


@query("delay_pairs", f"""
WITH {PAIRS_SQL}
SELECT event_id, user_id, gap, prev_delay_filled, prev_delay_filled > gap AS is_problem FROM pairs
""")
def delay_pairs(spark, folder):
    pairs = delays.pairs_from_history(table(spark, folder, "events"), "user_id", "ts", "event_id", "value")
    return pairs.select("event_id", "user_id", "gap", "prev_delay_filled", "is_problem")


@query("delay_whatif_grid", f"""
WITH {PAIRS_SQL},
scoped AS (
  SELECT 'all' AS scope, * FROM pairs
  UNION ALL SELECT 'purchase' AS scope, * FROM pairs WHERE event_type = 'purchase'),
totals AS (
  SELECT 'all' AS scope, count(*) AS total_rentals FROM events
  UNION ALL SELECT 'purchase', count(*) FROM events WHERE event_type = 'purchase'),
grid AS (SELECT CAST(range AS INTEGER) AS threshold FROM range(0, 721, 30)),
counted AS (
  SELECT g.threshold, s.scope,
         count(*) FILTER (WHERE prev_delay_filled > gap) AS problems,
         count(*) FILTER (WHERE prev_delay_filled > gap AND prev_delay_filled <= g.threshold) AS solved,
         count(*) FILTER (WHERE gap < g.threshold) AS affected
  FROM grid g CROSS JOIN scoped s GROUP BY 1, 2)
SELECT c.threshold, c.scope, t.total_rentals, c.problems, c.solved, c.affected,
       CASE WHEN c.problems > 0 THEN c.solved * 1.0::DOUBLE / c.problems * 100 ELSE 0.0 END AS pct_problems_solved,
       c.affected * 1.0::DOUBLE / t.total_rentals * 100 AS pct_rentals_affected
FROM counted c JOIN totals t USING (scope)
""")
def delay_whatif_grid(spark, folder):
    events = table(spark, folder, "events")
    pairs = delays.pairs_from_history(events, "user_id", "ts", "event_id", "value")
    return delays.threshold_curves(pairs, events, "event_type", "purchase", "gap")


@query("previous_by_key", """
WITH firsts AS (SELECT o_custkey, min(o_orderkey) AS first_order FROM orders GROUP BY 1),
linked AS (
  SELECT o.o_orderkey, o.o_custkey,
         CASE WHEN o.o_orderkey <> f.first_order THEN f.first_order END AS previous_id,
         CASE WHEN o.o_orderstatus = 'O' THEN NULL ELSE o.o_totalprice / 1000 END AS delay,
         CAST(o.o_orderkey % 300 AS BIGINT) AS gap
  FROM orders o JOIN firsts f USING (o_custkey))
SELECT l.o_orderkey, l.previous_id, l.gap, coalesce(p.delay, 0.0) AS prev_delay_filled,
       coalesce(p.delay, 0.0) > l.gap AS is_problem
FROM linked l LEFT JOIN linked p ON l.previous_id = p.o_orderkey
WHERE l.previous_id IS NOT NULL
""")
def previous_by_key(spark, folder):
    orders = table(spark, folder, "orders")
    firsts = orders.groupBy("o_custkey").agg(F.min("o_orderkey").alias("first_order"))
    linked = orders.join(firsts, "o_custkey").select(
        "o_orderkey",
        F.when(F.col("o_orderkey") != F.col("first_order"), F.col("first_order")).alias("previous_id"),
        F.when(F.col("o_orderstatus") == "O", None).otherwise(F.col("o_totalprice") / 1000).alias("delay"),
        (F.col("o_orderkey") % 300).alias("gap"),
    )
    pairs = joins.previous_pairs(linked, "o_orderkey", "previous_id", "delay", "gap")
    return pairs.select("o_orderkey", "previous_id", "gap", "prev_delay_filled", "is_problem")


@query("late_share", """
SELECT event_type, count(*) AS ended,
       count(*) FILTER (WHERE value > 60) AS late, count(*) FILTER (WHERE value <= 60) AS on_time,
       count(*) FILTER (WHERE value > 60) * 1.0::DOUBLE / count(*) * 100 AS late_pct,
       count(*) FILTER (WHERE value <= 60) * 1.0::DOUBLE / count(*) * 100 AS on_time_pct
FROM (SELECT event_type, CASE WHEN event_id % 10 = 0 THEN NULL ELSE value END AS value FROM events
      WHERE event_type <> 'error')
GROUP BY event_type
""")
def late_share(spark, folder):
    events = table(spark, folder, "events").select(
        "event_type", F.lit("ended").alias("state"),
        F.when(F.col("event_id") % 10 != 0, F.col("value") - 60).alias("delay"),
    ).filter(F.col("event_type") != "error")
    return delays.late_share(events, "state", "delay", "ended", ["event_type"])


@query("previous_event_gap", """
SELECT event_id, lag(event_id) OVER w AS prev_event_id,
       date_diff('microsecond', lag(ts) OVER w, ts) / 60000000.0::DOUBLE AS gap_minutes
FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id)
""")
def previous_event_gap(spark, folder):
    linked = ordering.previous_row(table(spark, folder, "events"), "event_type", "ts", "event_id", ["event_id"])
    return linked.select(
        "event_id", "prev_event_id",
        dates.minutes_between(F.col("ts"), F.col("prev_ts")).alias("gap_minutes"),
    )
