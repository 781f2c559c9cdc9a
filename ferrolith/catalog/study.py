"""Profiles, correlations, bins and chart tables."""

from pyspark.sql import functions as F

from ferrolith.catalog.registry import query
from ferrolith.functions import dates, numbers
from ferrolith.operators import aggregates, charts, joins, ordering, selection
from ferrolith.plans import dating
from ferrolith.sources.tables import table


def r6(df, *columns):
    return df.withColumns({c: F.round(c, 6) for c in columns})


@query("describe_quartiles_by_group", """
SELECT event_type, 'value' AS "column", count(value) AS count, round(avg(value), 6) AS mean,
       round(stddev_samp(value), 6) AS std, min(value) AS min, max(value) AS max,
       round(quantile_cont(value, 0.25), 6) AS q_25, round(quantile_cont(value, 0.5), 6) AS q_50,
       round(quantile_cont(value, 0.75), 6) AS q_75
FROM events GROUP BY event_type
""")
def describe_quartiles_by_group(spark, folder):
    stats = aggregates.describe(table(spark, folder, "events"), ["value"], ["event_type"], quartiles=True)
    return r6(stats, "mean", "std", "q_25", "q_50", "q_75")


@query("describe_overall", """
SELECT c AS "column", count(v) AS count, round(avg(v), 4) AS mean, round(stddev_samp(v), 4) AS std, min(v) AS min,
       max(v) AS max, round(quantile_cont(v, 0.25), 4) AS q_25, round(quantile_cont(v, 0.5), 4) AS q_50,
       round(quantile_cont(v, 0.75), 4) AS q_75
FROM (SELECT 'l_quantity' AS c, l_quantity AS v FROM lineitem UNION ALL
      SELECT 'l_extendedprice', l_extendedprice FROM lineitem UNION ALL SELECT 'l_tax', l_tax FROM lineitem) GROUP BY 1
""")
def describe_overall(spark, folder):
    stats = aggregates.describe(
        table(spark, folder, "lineitem"), ["l_quantity", "l_extendedprice", "l_tax"], quartiles=True)
    return stats.withColumns({c: F.round(c, 4) for c in ("mean", "std", "q_25", "q_50", "q_75")})


@query("describe_categorical", """
WITH long AS (SELECT 'o_orderstatus' AS c, o_orderstatus AS v FROM orders UNION ALL
              SELECT 'o_orderpriority', o_orderpriority FROM orders),
counts AS (SELECT c, v, count(*) AS n FROM long WHERE v IS NOT NULL GROUP BY 1, 2)
SELECT c AS "column", CAST(sum(n) AS BIGINT) AS count, count(*) AS "unique", max(n) AS freq,
       arg_min(v, (-n, v)) AS top FROM counts GROUP BY 1
""")
def describe_categorical(spark, folder):
    return aggregates.describe_categories(table(spark, folder, "orders"), ["o_orderstatus", "o_orderpriority"])


@query("missing_profile", """
WITH holes AS (SELECT CASE WHEN l_linenumber = 3 THEN NULL ELSE l_quantity END AS quantity,
                      CASE WHEN l_discount > 0.08 THEN NULL ELSE l_discount END AS discount, l_tax AS tax FROM lineitem)
SELECT c AS "column", count(*) AS rows, count(*) FILTER (WHERE v IS NULL) AS missing,
       count(*) FILTER (WHERE v IS NULL)::DOUBLE / count(*)::DOUBLE * 100 AS missing_pct
FROM (SELECT 'quantity' AS c, quantity AS v FROM holes UNION ALL SELECT 'discount', discount FROM holes
      UNION ALL SELECT 'tax', tax FROM holes) GROUP BY 1
""")
def missing_profile(spark, folder):
    holes = table(spark, folder, "lineitem").select(
        F.when(F.col("l_linenumber") != 3, F.col("l_quantity")).alias("quantity"),
        F.when(F.col("l_discount") <= 0.08, F.col("l_discount")).alias("discount"), F.col("l_tax").alias("tax"))
    return aggregates.missing_profile(holes, ["quantity", "discount", "tax"])


@query("share_of_total", """
SELECT lang, count(*) AS n, count(*)::DOUBLE / (SELECT count(*) FROM documents)::DOUBLE * 100 AS pct
FROM documents GROUP BY lang
""")
def share_of_total(spark, folder):
    return aggregates.shares(table(spark, folder, "documents"), ["lang"])


@query("imbalance_ratio", """
WITH counts AS (SELECT toxic, count(*) AS n FROM labels GROUP BY 1)
SELECT max(n) AS majority, min(n) AS minority, max(n)::DOUBLE / min(n)::DOUBLE AS imbalance_ratio FROM counts
""")
def imbalance_ratio(spark, folder):
    return aggregates.imbalance(table(spark, folder, "labels"), "toxic")


@query("median_by_category", """
SELECT p_brand, round(median(p_retailprice), 6) AS median_price FROM part GROUP BY 1
""")
def median_by_category(spark, folder):
    medians = ordering.exact_median(table(spark, folder, "part"), "p_retailprice", ["p_brand"], "median_price")
    return r6(medians, "median_price")


@query("stats_map_report", """
SELECT count(*) AS total, round(avg(p_retailprice), 6) AS mean, round(median(p_retailprice), 6) AS median,
       min(p_retailprice) AS min, max(p_retailprice) AS max, round(stddev_samp(p_retailprice), 6) AS std,
       (SELECT string_agg(p_type || '=' || m::VARCHAR, ';' ORDER BY p_type)
        FROM (SELECT p_type, CAST(round(median(p_retailprice) * 100) AS BIGINT) AS m FROM part GROUP BY 1)) AS by_type
FROM part
""")
def stats_map_report(spark, folder):
    report = aggregates.category_report(table(spark, folder, "part"), "p_retailprice", ["p_type", "p_brand"])
    entries = F.transform(
        F.array_sort(F.map_entries("by_p_type")),
        lambda e: F.concat(e["key"], F.lit("="), F.round(e["value"] * 100).cast("bigint").cast("string")))
    return r6(report, "mean", "median", "std").select(
        "total", "mean", "median", "min", "max", "std", F.array_join(entries, ";").alias("by_type"))


@query("exclude_band", """
SELECT l_orderkey, l_linenumber, l_partkey, wave FROM (
  SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_quantity > 45 THEN NULL ELSE l_quantity END AS wave FROM lineitem)
WHERE NOT coalesce(wave > 5 AND wave < 10, FALSE)
""")
def exclude_band(spark, folder):
    waves = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.when(F.col("l_quantity") <= 45, F.col("l_quantity")).alias("wave"))
    return selection.exclusion_band(waves, "wave", 5, 10)


@query("study_cleaning", """
SELECT count(*) AS n, goal_desc FROM (
  SELECT CASE l_linenumber WHEN 1 THEN 'Seamused a fun night out' WHEN 2 THEN 'Meet new people' WHEN 3 THEN 'Get a date'
           WHEN 4 THEN 'Looking for a serious relationship' WHEN 5 THEN 'To say I did it' WHEN 6 THEN 'Other' END AS goal_desc
  FROM lineitem WHERE NOT (l_quantity > 5 AND l_quantity < 10) AND l_returnflag <> 'N') GROUP BY 2
""")
def study_cleaning(spark, folder):
    meetings = table(spark, folder, "lineitem").select(
        F.col("l_quantity").alias("wave"), F.col("l_linenumber").alias("goal"),
        F.when(F.col("l_returnflag") != "N", 1).alias("dec"), F.lit(0).alias("dec_o"))
    return dating.clean(meetings).groupBy("goal_desc").agg(F.count("*").alias("n"))


@query("first_row_per_id", """
SELECT user_id, event_id, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1
""")
def first_row_per_id(spark, folder):
    firsts = selection.first_row(table(spark, folder, "events"), ["user_id"], ["ts", "event_id"])
    return firsts.select("user_id", "event_id", "event_type", "value")


@query("unpivot_means", """
SELECT l_returnflag, attribute, round(avg(v), 6) AS importance FROM (
  SELECT l_returnflag, 'l_quantity' AS attribute, l_quantity AS v FROM lineitem
  UNION ALL SELECT l_returnflag, 'l_discount', l_discount FROM lineitem
  UNION ALL SELECT l_returnflag, 'l_tax', l_tax FROM lineitem) GROUP BY 1, 2
""")
def unpivot_means(spark, folder):
    means = dating.preference_means(
        table(spark, folder, "lineitem"), ["l_quantity", "l_discount", "l_tax"], "l_returnflag")
    return r6(means, "importance")


@query("corr_by_group", """
SELECT c AS "column", round(max(CASE WHEN l_linestatus = 'F' THEN r END), 6) AS F,
       round(max(CASE WHEN l_linestatus = 'O' THEN r END), 6) AS O
FROM (SELECT l_linestatus, 'l_quantity' AS c, corr(l_quantity, l_extendedprice) AS r FROM lineitem GROUP BY 1
      UNION ALL SELECT l_linestatus, 'l_discount', corr(l_discount, l_extendedprice) FROM lineitem GROUP BY 1
      UNION ALL SELECT l_linestatus, 'l_tax', corr(l_tax, l_extendedprice) FROM lineitem GROUP BY 1) GROUP BY 1
""")
def corr_by_group(spark, folder):
    wide = dating.rating_correlations(
        table(spark, folder, "lineitem"), ["l_quantity", "l_discount", "l_tax"], "l_extendedprice", "l_linestatus",
        ["F", "O"])
    return r6(wide, "F", "O")


@query("corr_matrix_long", """
WITH m AS (
  SELECT corr(l_quantity, l_extendedprice) AS qe, corr(l_quantity, l_discount) AS qd,
         corr(l_extendedprice, l_discount) AS ed FROM lineitem)
SELECT x, y, round(corr, 6) AS corr FROM (
  SELECT 'l_quantity' AS x, 'l_extendedprice' AS y, qe AS corr FROM m UNION ALL SELECT 'l_extendedprice', 'l_quantity', qe FROM m
  UNION ALL SELECT 'l_quantity', 'l_discount', qd FROM m UNION ALL SELECT 'l_discount', 'l_quantity', qd FROM m
  UNION ALL SELECT 'l_extendedprice', 'l_discount', ed FROM m UNION ALL SELECT 'l_discount', 'l_extendedprice', ed FROM m
  UNION ALL SELECT c, c, 1.0::DOUBLE FROM (VALUES ('l_quantity'), ('l_extendedprice'), ('l_discount')) AS t(c))
""")
def corr_matrix_long(spark, folder):
    matrix = aggregates.correlation_matrix(
        table(spark, folder, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"])
    return r6(matrix, "corr")


@query("corr_pairwise_nulls", """
SELECT l_returnflag, 'half' AS "column",
       round(corr(CASE WHEN l_linenumber % 2 = 0 THEN l_quantity END, l_extendedprice), 6) AS corr
FROM lineitem GROUP BY 1
""")
def corr_pairwise_nulls(spark, folder):
    halves = table(spark, folder, "lineitem").withColumn(
        "half", F.when(F.col("l_linenumber") % 2 == 0, F.col("l_quantity")))
    return r6(aggregates.target_correlations(halves, ["half"], "l_extendedprice", "l_returnflag", together=False), "corr")


@query("right_closed_bins", """
SELECT CASE WHEN x > -1 AND x <= -0.33 THEN 'Faible' WHEN x > -0.33 AND x <= 0.33 THEN 'Moyenne'
            WHEN x > 0.33 AND x <= 1 THEN 'Forte' END AS interest, round(avg(y), 6) AS rate, count(*) AS n
FROM (SELECT (l_quantity - 25) / 25 AS x, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y FROM lineitem)
WHERE x > -1 AND x <= 1 GROUP BY 1
""")
def right_closed_bins(spark, folder):
    rows = table(spark, folder, "lineitem").select(
        ((F.col("l_quantity") - 25) / 25).alias("x"), (F.col("l_returnflag") == "R").cast("int").alias("y"))
    return r6(dating.rate_by_interest(rows, "x", "y"), "rate")


@query("self_vs_received", """
WITH own AS (SELECT DISTINCT c_custkey, c_mktsegment, c_acctbal FROM customer),
got AS (SELECT o_custkey AS c_custkey, avg(o_totalprice) AS received FROM orders GROUP BY 1)
SELECT c_custkey, c_mktsegment, c_acctbal, round(received, 7) AS received FROM own JOIN got USING (c_custkey)
""")
def self_vs_received(spark, folder):
    own = table(spark, folder, "customer").select("c_custkey", "c_mktsegment", "c_acctbal").distinct()
    orders = table(spark, folder, "orders").withColumnRenamed("o_custkey", "c_custkey")
    joined = joins.with_group_average(own, orders, "c_custkey", "o_totalprice", "received")
    return joined.withColumn("received", F.round("received", 7))


@query("self_vs_received_corr", """
WITH got AS (SELECT o_custkey, avg(o_totalprice) AS received FROM orders GROUP BY 1)
SELECT c_mktsegment, 'c_acctbal' AS "column", round(corr(c_acctbal, received), 6) AS corr
FROM customer JOIN got ON o_custkey = c_custkey GROUP BY 1
""")
def self_vs_received_corr(spark, folder):
    meetings = table(spark, folder, "customer").join(
        table(spark, folder, "orders"), F.col("c_custkey") == F.col("o_custkey"))
    image = dating.self_image(meetings, "c_custkey", "c_mktsegment", "c_acctbal", "o_totalprice")
    return r6(aggregates.target_correlations(image, ["c_acctbal"], "o_totalprice", "c_mktsegment"), "corr")


@query("rate_by_order", """
SELECT l_linenumber, round(avg(CASE WHEN l_returnflag = 'R' THEN 1.0::DOUBLE ELSE 0.0 END), 6) AS rate
FROM lineitem GROUP BY 1
""")
def rate_by_order(spark, folder):
    rows = table(spark, folder, "lineitem").select(
        "l_linenumber", (F.col("l_returnflag") == "R").cast("double").alias("dec"))
    return r6(dating.rate_by(rows, "l_linenumber", "dec"), "rate")


@query("trend_line", """
SELECT l_returnflag, round(regr_slope(l_extendedprice, l_quantity), 4) AS slope,
       round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept,
       round(regr_r2(l_extendedprice, l_quantity), 6) AS r2, count(*) AS n FROM lineitem GROUP BY 1
""")
def trend_line(spark, folder):
    lines = charts.trend_lines(table(spark, folder, "lineitem"), "l_quantity", "l_extendedprice", ["l_returnflag"])
    return lines.withColumns({"slope": F.round("slope", 4), "intercept": F.round("intercept", 4), "r2": F.round("r2", 6)})


@query("bool_premium", """
SELECT feature, round(delta, 4) AS delta FROM (
  SELECT 'returned' AS feature, avg(l_extendedprice) FILTER (WHERE l_returnflag = 'R')
         - avg(l_extendedprice) FILTER (WHERE l_returnflag <> 'R') AS delta FROM lineitem
  UNION ALL SELECT 'open', avg(l_extendedprice) FILTER (WHERE l_linestatus = 'O')
         - avg(l_extendedprice) FILTER (WHERE l_linestatus <> 'O') FROM lineitem
  UNION ALL SELECT 'taxed', avg(l_extendedprice) FILTER (WHERE l_tax > 0)
         - avg(l_extendedprice) FILTER (WHERE l_tax <= 0) FROM lineitem)
""")
def bool_premium(spark, folder):
    rows = table(spark, folder, "lineitem").select(
        "l_extendedprice", (F.col("l_returnflag") == "R").alias("returned"),
        (F.col("l_linestatus") == "O").alias("open"), (F.col("l_tax") > 0).alias("taxed"))
    premiums = aggregates.true_premium(rows, ["returned", "open", "taxed"], "l_extendedprice")
    return premiums.withColumn("delta", F.round("delta", 4))


@query("three_sigma_sequential", """
WITH base AS (SELECT event_id, value, ln(1 + value) AS logv FROM events),
s1 AS (SELECT * FROM base WHERE value BETWEEN (SELECT avg(value) - stddev_samp(value) * 3 FROM base)
                                          AND (SELECT avg(value) + stddev_samp(value) * 3 FROM base)),
s2 AS (SELECT * FROM s1 WHERE logv BETWEEN (SELECT avg(logv) - stddev_samp(logv) * 3 FROM s1)
                                       AND (SELECT avg(logv) + stddev_samp(logv) * 3 FROM s1))
SELECT event_id, value FROM s2
""")
def three_sigma_sequential(spark, folder):
    base = table(spark, folder, "events").select("event_id", "value", F.log1p("value").alias("logv"))
    return selection.sigma_filter(base, ["value", "logv"]).select("event_id", "value")


@query("date_parts", """
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
       CAST(day(o_orderdate) AS INTEGER) AS day, CAST(isodow(o_orderdate) - 1 AS INTEGER) AS weekday FROM orders
""")
def date_parts(spark, folder):
    written = F.date_format("o_orderdate", "dd-MM-yyyy")
    parsed = table(spark, folder, "orders").withColumn("day_of_order", dates.parse_date(written, "dd-MM-yyyy"))
    parts = dates.date_parts(F.col("day_of_order"))
    return parsed.select("o_orderkey", *[part.alias(name) for name, part in parts.items()])


@query("hour_weekday_counts", """
SELECT CAST(isodow(ts) - 1 AS INTEGER) AS weekday, CAST(hour(ts) AS INTEGER) AS hour, count(*) AS n FROM events GROUP BY 1, 2
""")
def hour_weekday_counts(spark, folder):
    return table(spark, folder, "events").groupBy(
        dates.weekday(F.col("ts")).alias("weekday"), F.hour("ts").alias("hour")).agg(F.count("*").alias("n"))


@query("histogram_equal_width", """
WITH lim AS (SELECT min(value) AS lo, max(value) AS hi FROM events)
SELECT event_type, CAST(least(49, floor((value - lo) / ((hi - lo) / 50))) AS INTEGER) AS bin, count(*) AS n,
       round(any_value(lo) + CAST(least(49, floor((value - lo) / ((hi - lo) / 50))) AS INTEGER) * any_value((hi - lo) / 50), 6) AS bin_start,
       round(any_value(lo) + (CAST(least(49, floor((value - lo) / ((hi - lo) / 50))) AS INTEGER) + 1) * any_value((hi - lo) / 50), 6) AS bin_end
FROM events, lim GROUP BY event_type, CAST(least(49, floor((value - lo) / ((hi - lo) / 50))) AS INTEGER)
""")
def histogram_equal_width(spark, folder):
    return r6(charts.histogram(table(spark, folder, "events"), "value", 50, ["event_type"]), "bin_start", "bin_end")


@query("histogram_range", """
SELECT event_type, floor(v / 20) * 20 AS bin_start, count(*) AS n
FROM (SELECT event_type, value * 3 - 300 AS v FROM events) WHERE v BETWEEN -300 AND 720 GROUP BY 1, 2
""")
def histogram_range(spark, folder):
    shifted = table(spark, folder, "events").select("event_type", (F.col("value") * 3 - 300).alias("v"))
    return charts.ranged_histogram(shifted, "v", -300, 720, 80, ["event_type"])


@query("boxplot_stats", """
WITH q AS (SELECT event_type, quantile_cont(value, 0.25) AS a, quantile_cont(value, 0.5) AS b, quantile_cont(value, 0.75) AS c
           FROM events GROUP BY 1)
SELECT e.event_type, round(a, 6) AS q_25, round(b, 6) AS q_50, round(c, 6) AS q_75,
       min(value) FILTER (WHERE value BETWEEN a - (c - a) * 1.5 AND c + (c - a) * 1.5) AS whisker_low,
       max(value) FILTER (WHERE value BETWEEN a - (c - a) * 1.5 AND c + (c - a) * 1.5) AS whisker_high,
       count(*) FILTER (WHERE NOT value BETWEEN a - (c - a) * 1.5 AND c + (c - a) * 1.5) AS outliers, count(*) AS n
FROM events e JOIN q USING (event_type) GROUP BY e.event_type, a, b, c
""")
def boxplot_stats(spark, folder):
    return r6(charts.box_stats(table(spark, folder, "events"), "value", ["event_type"]), "q_25", "q_50", "q_75")


@query("boxplot_outliers", """
WITH q AS (SELECT event_type, quantile_cont(value, 0.25) AS a, quantile_cont(value, 0.75) AS c FROM events GROUP BY 1)
SELECT event_id, event_type, value FROM events JOIN q USING (event_type)
WHERE value < a - (c - a) * 1.5 OR value > c + (c - a) * 1.5
""")
def boxplot_outliers(spark, folder):
    rows = table(spark, folder, "events").select("event_id", "event_type", "value")
    return charts.outliers(rows, "value", ["event_type"])


@query("mean_with_band", """
SELECT l_linenumber, round(avg(l_extendedprice), 4) AS mean,
       round(avg(l_extendedprice) - 1.96 * stddev_samp(l_extendedprice) / sqrt(count(*)), 4) AS low,
       round(avg(l_extendedprice) + 1.96 * stddev_samp(l_extendedprice) / sqrt(count(*)), 4) AS high
FROM lineitem GROUP BY 1
""")
def mean_with_band(spark, folder):
    bands = charts.mean_bands(table(spark, folder, "lineitem"), "l_linenumber", "l_extendedprice")
    return bands.withColumns({c: F.round(c, 4) for c in ("mean", "low", "high")})


@query("ordered_counts", """
WITH c AS (SELECT p_type, p_brand, count(*) AS n FROM part GROUP BY 1, 2)
SELECT p_type, p_brand, n, CAST(sum(n) OVER (PARTITION BY p_type) AS BIGINT) AS total FROM c
""")
def ordered_counts(spark, folder):
    return charts.ordered_counts(table(spark, folder, "part"), "p_type", "p_brand")


@query("code_labels", """
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' END AS state FROM orders
""")
def code_labels(spark, folder):
    return table(spark, folder, "orders").select(
        "o_orderkey", numbers.code_label(F.col("o_orderstatus"), {"F": "finished", "O": "open"}).alias("state"))


@query("random_sample", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY md5(CAST(o_orderkey AS VARCHAR) || '#42'), o_orderkey LIMIT 100
""")
def random_sample(spark, folder):
    return selection.random_sample(table(spark, folder, "orders"), "o_orderkey", 100, 42).select(
        "o_orderkey", "o_totalprice")


@query("set_difference", """
SELECT DISTINCT p_partkey AS id FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 40)
""")
def set_difference(spark, folder):
    sold = table(spark, folder, "lineitem").filter(F.col("l_quantity") > 40).select(F.col("l_partkey").alias("id"))
    return selection.difference(table(spark, folder, "part").select(F.col("p_partkey").alias("id")), sold)


@query("group_difference", """
SELECT l_returnflag, round(avg(l_quantity) - 25, 6) AS surplus FROM lineitem GROUP BY 1
""")
def group_difference(spark, folder):
    means = aggregates.means(table(spark, folder, "lineitem"), ["l_quantity"], ["l_returnflag"])
    return means.select("l_returnflag", F.round(F.col("l_quantity") - 25, 6).alias("surplus"))


@query("argmax_per_row", """
SELECT l_orderkey, l_partkey, l_linenumber,
       CASE WHEN l_discount >= l_tax AND l_discount >= l_quantity / 500 THEN 'l_discount'
            WHEN l_tax >= l_quantity / 500 THEN 'l_tax' ELSE 'share' END AS best FROM lineitem
""")
def argmax_per_row(spark, folder):
    rows = table(spark, folder, "lineitem").withColumn("share", F.col("l_quantity") / 500)
    return selection.best_column(rows, ["l_discount", "l_tax", "share"]).select(
        "l_orderkey", "l_partkey", "l_linenumber", "best")


@query("grouped_means", """
SELECT c_nationkey, round(avg(c_acctbal), 4) AS c_acctbal, round(avg(c_custkey), 4) AS c_custkey FROM customer GROUP BY 1
""")
def grouped_means(spark, folder):
    means = aggregates.means(table(spark, folder, "customer"), ["c_acctbal", "c_custkey"], ["c_nationkey"])
    return means.withColumns({c: F.round(c, 4) for c in ("c_acctbal", "c_custkey")})


@query("distinct_rows", "SELECT DISTINCT o_custkey, o_orderstatus, o_orderpriority FROM orders")
def distinct_rows(spark, folder):
    return table(spark, folder, "orders").select("o_custkey", "o_orderstatus", "o_orderpriority").distinct()
