"""Evaluation, split and feature-preparation queries.

`labels` with `documents` stands in for the visitor table; the score column is
a fixed expression, so the SQL twin sees the same numbers.
"""

from pyspark.sql import functions as F

from ferrolith.catalog.registry import query
from ferrolith.functions import numbers
from ferrolith.operators import evaluate, joins, prepare, selection
from ferrolith.sources.tables import table

SCORED_SQL = """
scored AS (SELECT doc_id, toxic AS y, lang, (doc_id * 37 % 101) / 100.0::DOUBLE * 0.7 + toxic * 0.2 + quality * 0.05 AS score
           FROM labels JOIN documents USING (doc_id)),
judged AS (SELECT *, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS p FROM scored)
"""


def scored(spark, folder):
    rows = table(spark, folder, "labels").join(table(spark, folder, "documents").select("doc_id", "lang"), "doc_id")
    score = (F.col("doc_id") * 37 % 101) / 100.0 * 0.7 + F.col("toxic") * 0.2 + F.col("quality") * 0.05
    return rows.select("doc_id", F.col("toxic").alias("y"), "lang", score.alias("score"))


def judged(spark, folder):
    return scored(spark, folder).withColumn("p", (F.col("score") >= 0.5).cast("int"))


VISITS_SQL = """
visits AS (SELECT o_orderkey AS id, o_orderstatus AS country, o_orderpriority AS source,
                  CAST(17 + o_custkey % 50 AS INTEGER) AS age, CAST(o_orderkey * 7 % 29 AS INTEGER) AS total_pages_visited,
                  CASE WHEN o_orderkey * 7 % 29 > 14 THEN 1 ELSE 0 END AS converted FROM orders),
feats AS (SELECT *, total_pages_visited / (age + 0.1::DOUBLE) AS pages_per_age,
                 age * total_pages_visited AS interaction_age_pages,
                 CASE WHEN total_pages_visited > 2 THEN 1 ELSE 0 END AS is_active FROM visits)
"""


def visits(spark, folder):
    pages = F.col("o_orderkey") * 7 % 29
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("country"), F.col("o_orderpriority").alias("source"),
        (F.col("o_custkey") % 50 + 17).cast("int").alias("age"), pages.cast("int").alias("total_pages_visited"),
        (pages > 14).cast("int").alias("converted"))


@query("regression_metrics", """
WITH r AS (SELECT l_returnflag, l_extendedprice AS y, l_quantity * 1500 AS p FROM lineitem),
m AS (SELECT l_returnflag, avg(y) AS my FROM r GROUP BY 1)
SELECT l_returnflag, round(1 - sum((y - p) * (y - p)) / sum((y - my) * (y - my)), 6) AS r2,
       round(sqrt(avg((y - p) * (y - p))), 4) AS rmse, round(avg(abs(y - p)), 4) AS mae, count(*) AS n
FROM r JOIN m USING (l_returnflag) GROUP BY 1
""")
def regression_metrics(spark, folder):
    rows = table(spark, folder, "lineitem").select(
        "l_returnflag", F.col("l_extendedprice").alias("y"), (F.col("l_quantity") * 1500).alias("p"))
    metrics = evaluate.regression_metrics(rows, "y", "p", ["l_returnflag"])
    return metrics.withColumns({"r2": F.round("r2", 6), "rmse": F.round("rmse", 4), "mae": F.round("mae", 4)})


@query("confusion_matrix", f"WITH {SCORED_SQL} SELECT y, p, count(*) AS n FROM judged GROUP BY 1, 2")
def confusion_matrix(spark, folder):
    return evaluate.confusion(judged(spark, folder), "y", "p")


@query("class_report", f"""
WITH {SCORED_SQL},
c AS (SELECT l AS label, (SELECT count(*) FROM judged WHERE y = l) AS support,
             (SELECT count(*) FROM judged WHERE p = l) AS guessed,
             (SELECT count(*) FROM judged WHERE y = l AND p = l) AS hit FROM (VALUES (0), (1)) AS t(l)),
m AS (SELECT CAST(label AS VARCHAR) AS label, CASE WHEN guessed = 0 THEN 0.0 ELSE hit::DOUBLE / guessed END AS precision,
             hit::DOUBLE / support AS recall, 2.0::DOUBLE * hit / (guessed + support) AS f1, support, hit FROM c)
SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM m
UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), CAST(sum(support) AS BIGINT) FROM m
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6),
                 round(sum(f1 * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM m
UNION ALL SELECT 'accuracy', round(sum(hit)::DOUBLE / sum(support), 6), round(sum(hit)::DOUBLE / sum(support), 6),
                 round(sum(hit)::DOUBLE / sum(support), 6), CAST(sum(support) AS BIGINT) FROM m
""")
def class_report(spark, folder):
    report = evaluate.class_report(judged(spark, folder), "y", "p")
    return report.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1")})


@query("binary_metrics", f"""
WITH {SCORED_SQL},
c AS (SELECT lang, count(*) AS n, count(*) FILTER (WHERE y = 1 AND p = 1) AS tp, count(*) FILTER (WHERE y = 0 AND p = 1) AS fp,
             count(*) FILTER (WHERE y = 1 AND p = 0) AS fn FROM judged GROUP BY 1)
SELECT lang, (n - fp - fn)::DOUBLE / n AS accuracy, coalesce(tp::DOUBLE / nullif(tp + fp, 0), 0) AS precision,
       coalesce(tp::DOUBLE / nullif(tp + fn, 0), 0) AS recall, coalesce(2.0::DOUBLE * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1 FROM c
""")
def binary_metrics(spark, folder):
    return evaluate.binary_metrics(judged(spark, folder), "y", "p", ["lang"])


@query("roc_auc", f"""
WITH {SCORED_SQL},
s AS (SELECT score, count(*) FILTER (WHERE y = 1) AS pos, count(*) FILTER (WHERE y = 0) AS neg FROM scored GROUP BY 1),
r AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM s)
SELECT round(CAST(sum(pos * (below + neg / 2.0::DOUBLE)) AS DOUBLE) / (sum(pos) * sum(neg))::DOUBLE, 8) AS roc_auc FROM r
""")
def roc_auc(spark, folder):
    return evaluate.roc_auc(scored(spark, folder), "y", "score").withColumn("roc_auc", F.round("roc_auc", 8))


@query("f1_threshold_sweep", f"""
WITH {SCORED_SQL},
grid AS (SELECT range AS i, 0.3::DOUBLE + range * 0.005::DOUBLE AS threshold FROM range(0, 60)),
c AS (SELECT i, threshold, count(*) FILTER (WHERE y = 1 AND score >= threshold) AS tp,
             count(*) FILTER (WHERE y = 0 AND score >= threshold) AS fp,
             count(*) FILTER (WHERE y = 1 AND score < threshold) AS fn FROM grid CROSS JOIN scored GROUP BY 1, 2),
f AS (SELECT *, coalesce(2.0::DOUBLE * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1 FROM c)
SELECT round(threshold, 6) AS threshold, tp, fp, fn, round(f1, 8) AS f1, row_number() OVER (ORDER BY f1 DESC, i) = 1 AS is_best FROM f
""")
def f1_threshold_sweep(spark, folder):
    sweep = evaluate.threshold_sweep(scored(spark, folder), "y", "score", evaluate.GRID_FINE)
    return sweep.withColumns({"threshold": F.round("threshold", 6), "f1": F.round("f1", 8)})


@query("model_comparison", f"""
WITH {SCORED_SQL},
m AS (SELECT 'half' AS model, (2.0::DOUBLE * count(*) FILTER (WHERE y = 1 AND score >= 0.5))
        / nullif(count(*) FILTER (WHERE y = 1) + count(*) FILTER (WHERE score >= 0.5), 0) AS f1 FROM scored
      UNION ALL SELECT 'strict', (2.0::DOUBLE * count(*) FILTER (WHERE y = 1 AND score >= 0.65))
        / nullif(count(*) FILTER (WHERE y = 1) + count(*) FILTER (WHERE score >= 0.65), 0) FROM scored)
SELECT model, round(f1, 8) AS f1, f1 = (SELECT max(f1) FROM m) AS is_best FROM m
""")
def model_comparison(spark, folder):
    rows = scored(spark, folder)
    both = rows.select("y", F.explode(F.create_map(
        F.lit("half"), (F.col("score") >= 0.5).cast("int"),
        F.lit("strict"), (F.col("score") >= 0.65).cast("int"))).alias("model", "p"))
    metrics = evaluate.binary_metrics(both, "y", "p", ["model"]).select("model", "f1")
    return evaluate.compare_models(metrics, "model", "f1").withColumn("f1", F.round("f1", 8))


@query("prediction_audit", f"""
WITH {SCORED_SQL}
SELECT doc_id, CASE y WHEN 0 THEN 'ham' WHEN 1 THEN 'spam' END AS actual, CASE p WHEN 0 THEN 'ham' WHEN 1 THEN 'spam' END AS predicted,
       round(abs(score - y), 8) AS abs_error, y = p AS correct FROM judged
""")
def prediction_audit(spark, folder):
    labels = {0: "ham", 1: "spam"}
    audited = evaluate.audit(judged(spark, folder), "y", "p")
    return audited.select(
        "doc_id", numbers.code_label(F.col("y"), labels).alias("actual"),
        numbers.code_label(F.col("p"), labels).alias("predicted"),
        F.round(F.abs(F.col("score") - F.col("y")), 8).alias("abs_error"), "correct")


@query("first_errors", f"""
WITH {SCORED_SQL} SELECT doc_id, y, p FROM judged WHERE y <> p ORDER BY doc_id LIMIT 5
""")
def first_errors(spark, folder):
    return evaluate.first_errors(evaluate.audit(judged(spark, folder), "y", "p"), ["doc_id"]).select("doc_id", "y", "p")


@query("hash_split", """
WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY md5(CAST(o_orderkey AS VARCHAR) || '#42')) AS rk, count(*) OVER () AS n FROM orders)
SELECT o_orderkey, rk <= ceil(n * 0.2::DOUBLE) AS is_test FROM r
""")
def hash_split(spark, folder):
    return prepare.holdout(table(spark, folder, "orders").select("o_orderkey"), "o_orderkey")


@query("stratified_split", """
WITH r AS (SELECT o_orderkey, o_orderstatus,
                  row_number() OVER (PARTITION BY o_orderstatus ORDER BY md5(CAST(o_orderkey AS VARCHAR) || '#42')) AS rk,
                  count(*) OVER (PARTITION BY o_orderstatus) AS n FROM orders)
SELECT o_orderkey, o_orderstatus, rk <= ceil(n * 0.2::DOUBLE) AS is_test FROM r
""")
def stratified_split(spark, folder):
    return prepare.holdout(
        table(spark, folder, "orders").select("o_orderkey", "o_orderstatus"), "o_orderkey", by=["o_orderstatus"])


@query("stratified_folds", """
SELECT doc_id, toxic,
       CAST((row_number() OVER (PARTITION BY toxic ORDER BY md5(CAST(doc_id AS VARCHAR) || '#42')) - 1) % 5 AS INTEGER) AS fold
FROM labels
""")
def stratified_folds(spark, folder):
    return prepare.folds(table(spark, folder, "labels").select("doc_id", "toxic"), "doc_id", by=["toxic"])


@query("label_encode", """
WITH codes AS (SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS INTEGER) AS code FROM (
  SELECT DISTINCT n_name AS v FROM nation UNION SELECT r_name FROM region))
SELECT s_suppkey, n_name, code AS n_code FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN codes ON v = n_name
""")
def label_encode(spark, folder):
    nation = table(spark, folder, "nation").select("n_nationkey", F.col("n_name").alias("name"))
    region = table(spark, folder, "region").select(F.col("r_name").alias("name"))
    codes = prepare.label_codes([nation, region], "name")
    rows = table(spark, folder, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    return prepare.encode_labels(rows, "name", codes, "n_code").select(
        "s_suppkey", F.col("name").alias("n_name"), "n_code")


@query("impute_scale", """
WITH b AS (SELECT l_orderkey, l_partkey, l_linenumber, CASE WHEN l_linenumber = 3 THEN NULL ELSE l_quantity END AS q, l_tax AS t FROM lineitem),
s AS (SELECT avg(q) AS mq, sqrt(var_pop(q) * count(q) / count(*)) AS sq, avg(t) AS mt, stddev_pop(t) AS st FROM b)
SELECT l_orderkey, l_partkey, l_linenumber, round((coalesce(q, mq) - mq) / sq, 6) AS q, round((t - mt) / st, 6) AS t FROM b, s
""")
def impute_scale(spark, folder):
    rows = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", F.when(F.col("l_linenumber") != 3, F.col("l_quantity")).alias("q"), F.col("l_tax").alias("t"))
    return prepare.fill_and_scale(rows, ["q", "t"]).withColumns({"q": F.round("q", 6), "t": F.round("t", 6)})


@query("impute_most_frequent", """
WITH b AS (SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderpriority END AS level FROM orders),
m AS (SELECT level FROM b WHERE level IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, level LIMIT 1)
SELECT o_orderkey, coalesce(level, (SELECT level FROM m)) AS level FROM b
""")
def impute_most_frequent(spark, folder):
    rows = table(spark, folder, "orders").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 4 != 0, F.col("o_orderpriority")).alias("level"))
    return prepare.fill_most_frequent(rows, ["level"])


@query("visit_features", f"""
WITH {VISITS_SQL} SELECT id, round(pages_per_age, 8) AS pages_per_age, interaction_age_pages, is_active FROM feats
""")
def visit_features(spark, folder):
    rows = prepare.visit_features(visits(spark, folder))
    return rows.select("id", F.round("pages_per_age", 8).alias("pages_per_age"), "interaction_age_pages", "is_active")


@query("heuristic_score", f"""
WITH {VISITS_SQL},
q AS (SELECT quantile_cont(pages_per_age, 0.75) AS hi, quantile_cont(interaction_age_pages, 0.25) AS lo FROM feats),
s AS (SELECT id, (CASE WHEN total_pages_visited <= 2 THEN 0.4::DOUBLE ELSE 0 END) + (CASE WHEN pages_per_age > hi THEN 0.4::DOUBLE ELSE 0 END)
             + (CASE WHEN interaction_age_pages < lo THEN 0.2::DOUBLE ELSE 0 END) AS score, (id % 97) / 96.0::DOUBLE AS p FROM feats, q)
SELECT id, round(score, 8) AS rule_score, round(least(1, greatest(0, p + 0.15 * score)), 8) AS final_score FROM s
""")
def heuristic_score(spark, folder):
    rows = prepare.visit_features(visits(spark, folder))
    ruled = prepare.rule_score(rows, rows).withColumn("p", (F.col("id") % 97) / 96.0)
    return ruled.select(
        "id", F.round("rule_score", 8).alias("rule_score"), F.round(prepare.boosted_score("p"), 8).alias("final_score"))


@query("interval_struct", """
SELECT p_partkey, round_even(greatest(0.0, p_retailprice - p_retailprice * 0.15::DOUBLE) * 100.0::DOUBLE, 0) / 100.0::DOUBLE AS low,
       round_even((p_retailprice + p_retailprice * 0.15::DOUBLE) * 100.0::DOUBLE, 0) / 100.0::DOUBLE AS high FROM part
""")
def interval_struct(spark, folder):
    interval = numbers.price_interval(F.col("p_retailprice"))
    return table(spark, folder, "part").select("p_partkey", interval.alias("i")).select("p_partkey", "i.low", "i.high")


@query("union_train_test", """
SELECT DISTINCT v FROM (SELECT c_mktsegment AS v FROM customer UNION ALL SELECT p_type FROM part)
""")
def union_train_test(spark, folder):
    left = table(spark, folder, "customer").select(F.col("c_mktsegment").alias("v"))
    return left.unionByName(table(spark, folder, "part").select(F.col("p_type").alias("v"))).distinct()


@query("select_rename", """
SELECT s_suppkey AS id, s_name AS name, s_acctbal AS balance FROM supplier
""")
def select_rename(spark, folder):
    return selection.pick(table(spark, folder, "supplier"), {"s_suppkey": "id", "s_name": "name", "s_acctbal": "balance"})


@query("incremental_anti_join", """
SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'N')
""")
def incremental_anti_join(spark, folder):
    done = table(spark, folder, "lineitem").filter(F.col("l_returnflag") == "N").select(F.col("l_orderkey").alias("o_orderkey"))
    return joins.only_new(table(spark, folder, "orders").select("o_orderkey", "o_custkey"), done, ["o_orderkey"])
