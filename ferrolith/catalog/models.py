"""Model queries. Linear fits have a SQL twin; other fitted models return rows only.

The library defaults are the studies' settings; the queries use them, and every row.
"""

from pyspark.ml import PipelineModel
from pyspark.ml.feature import Word2Vec
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from ferrolith.catalog.registry import query
from ferrolith.functions import dates, numbers, text
from ferrolith.models import boosting, classification, features, grouping, linear, regression
from ferrolith.operators import evaluate, prepare, selection, words
from ferrolith.operators.dbscan_sweep import sparse_vectors
from ferrolith.operators.ordering import random_rank
from ferrolith.session import new_folder, settle
from ferrolith.sources.tables import table

NUMERIC = ["l_quantity", "l_discount", "l_tax", "year", "month", "day", "weekday"]
CATEGORIES = ["l_returnflag", "l_linestatus"]


def sales(spark, folder):
    """Cleaned sales rows with date parts, outliers removed, an id, a hold-out flag and folds from one random rank."""
    rows = table(spark, folder, "lineitem").withColumns({n: c for n, c in dates.date_parts(F.col("l_shipdate")).items()})
    kept = selection.sigma_filter(rows, ["l_quantity", "l_discount", "l_tax"])
    keyed = kept.withColumn("row_id", F.concat_ws("-", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"))
    ranked = random_rank(keyed, "row_id", 42, name="rank")
    size = keyed.select(F.count("*")).scalar()
    return ranked.select("*", (F.col("rank") <= F.ceil(size * F.lit(0.2))).alias("is_test"), ((F.col("rank") - 1) % 5).cast("int").alias("fold"))


def sales_products(spark, folder):
    """Training and hold-out rows, the model's inputs, and the sums by fold of the training rows."""
    rows = settle(sales(spark, folder).select("row_id", "l_extendedprice", "fold", "is_test", *NUMERIC, *CATEGORIES))
    train, test = rows.filter(~F.col("is_test")), rows.filter("is_test")
    inputs = linear.scaled_inputs(train, NUMERIC, CATEGORIES)
    return train, test, inputs, linear.products(train, inputs, "l_extendedprice", "fold", 5)


# The SQL twins: sums of products of (1, inputs, label), then elimination or coordinate descent over lists.
_SALES = """
WITH RECURSIVE parts AS (SELECT concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber) AS row_id, l_extendedprice AS y, l_quantity, l_discount,
    l_tax, year(l_shipdate)::DOUBLE AS yr, month(l_shipdate)::DOUBLE AS mo, day(l_shipdate)::DOUBLE AS dy, (isodow(l_shipdate) - 1)::DOUBLE AS wd,
    l_returnflag AS rf, l_linestatus AS ls FROM lineitem),
s1 AS (SELECT * FROM parts WHERE l_quantity BETWEEN (SELECT avg(l_quantity) - 3 * stddev_samp(l_quantity) FROM parts) AND (SELECT avg(l_quantity) + 3 * stddev_samp(l_quantity) FROM parts)),
s2 AS (SELECT * FROM s1 WHERE l_discount BETWEEN (SELECT avg(l_discount) - 3 * stddev_samp(l_discount) FROM s1) AND (SELECT avg(l_discount) + 3 * stddev_samp(l_discount) FROM s1)),
s3 AS (SELECT * FROM s2 WHERE l_tax BETWEEN (SELECT avg(l_tax) - 3 * stddev_samp(l_tax) FROM s2) AND (SELECT avg(l_tax) + 3 * stddev_samp(l_tax) FROM s2)),
ranked AS (SELECT *, row_number() OVER (ORDER BY md5(row_id || '#42')) AS rk, count(*) OVER () AS n FROM s3),
split AS (SELECT *, rk <= ceil(n * 0.2::DOUBLE) AS is_test, (rk - 1) % 5 AS fold FROM ranked),
st AS (SELECT avg(l_quantity) AS m1, stddev_pop(l_quantity) AS d1, avg(l_discount) AS m2, stddev_pop(l_discount) AS d2, avg(l_tax) AS m3, stddev_pop(l_tax) AS d3,
    avg(yr) AS m4, stddev_pop(yr) AS d4, avg(mo) AS m5, stddev_pop(mo) AS d5, avg(dy) AS m6, stddev_pop(dy) AS d6, avg(wd) AS m7, stddev_pop(wd) AS d7
  FROM split WHERE NOT is_test),
v AS (SELECT fold, is_test, y, [1.0, (l_quantity - m1) / d1, (l_discount - m2) / d2, (l_tax - m3) / d3, (yr - m4) / d4, (mo - m5) / d5, (dy - m6) / d6,
    (wd - m7) / d7, (rf = 'N')::INT, (rf = 'R')::INT, (ls = 'O')::INT, y]::DOUBLE[] AS v FROM split, st),
agg AS (SELECT fold, i, j, sum(v[i] * v[j]) AS s FROM v, range(1, 13) a(i), range(1, 13) b(j) WHERE NOT is_test GROUP BY ALL),
"""
_SYSTEMS = """
jobs AS (SELECT unnest({alphas})::DOUBLE AS alpha, f FROM range(-1, 5) r(f)),
cells AS (SELECT alpha, f, i, j, sum(s) FILTER (fold <> f) AS s FROM agg, jobs GROUP BY ALL),
lines AS (SELECT alpha, f, i, list(s + {penalty} ORDER BY j) AS r FROM cells WHERE i <= 11 GROUP BY ALL),
mats AS (SELECT alpha, f, list(r ORDER BY i) AS m FROM lines GROUP BY ALL),
"""
_GAUSS = """
gauss AS (SELECT alpha, f, 1 AS k, m FROM mats UNION ALL
  SELECT alpha, f, k + 1, list_transform(m, lambda r, i: CASE WHEN i = k THEN list_transform(r, lambda x: x / m[k][k])
    ELSE list_transform(r, lambda x, j: x - r[k] * m[k][j] / m[k][k]) END) FROM gauss WHERE k <= 11),
fits AS (SELECT alpha, f, list_transform(m, lambda r: r[12]) AS b FROM gauss WHERE k = 12)
"""
_DESCENT = """
descent AS (SELECT alpha, f, 0 AS k, m, list_transform(range(11), lambda x: 0.0::DOUBLE) AS b FROM mats UNION ALL
  SELECT alpha, f, k + 1, m, list_transform(b, lambda x, i: CASE WHEN i <> k % 11 + 1 THEN x ELSE
    sign(m[i][12] - list_dot_product(m[i][1:11], b) + m[i][i] * x) * greatest(abs(m[i][12] - list_dot_product(m[i][1:11], b) + m[i][i] * x)
      - CASE WHEN i > 1 THEN alpha * m[1][1] ELSE 0 END, 0) / m[i][i] END) FROM descent WHERE k < 11 * 150),
fits AS (SELECT alpha, f, b FROM descent WHERE k = 11 * 150)
"""
_EVALUATED = """,
scored AS (SELECT alpha, f, is_test, y, list_dot_product(b, v[1:11]) AS p FROM fits JOIN v ON (f = -1) OR (NOT is_test AND fold = f)),
r2 AS (SELECT alpha, f, is_test, 1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)) AS r2, sqrt(avg((y - p) * (y - p))) AS rmse, avg(abs(y - p)) AS mae
  FROM scored GROUP BY ALL),
best AS (SELECT alpha FROM r2 WHERE f >= 0 GROUP BY alpha ORDER BY avg(r2) DESC, alpha LIMIT 1)
SELECT '{name}' AS model, round(a.r2, 9) AS train_r2, round(t.r2, 9) AS test_r2, round(t.rmse, 6) AS test_rmse, round(t.mae, 6) AS test_mae, alpha
FROM best JOIN r2 a USING (alpha) JOIN r2 t USING (alpha) WHERE a.f = -1 AND t.f = -1 AND NOT a.is_test AND t.is_test
"""


def _cross_validated_sql(name, alphas):
    penalty = "CASE WHEN i = j AND i > 1 THEN alpha ELSE 0 END" if name == "ridge" else "0"
    return _SALES + _SYSTEMS.format(alphas=list(alphas), penalty=penalty) + (_GAUSS if name == "ridge" else _DESCENT) + _EVALUATED.format(name=name)


@query("ols", _SALES + _SYSTEMS.format(alphas=[0], penalty="0") + _GAUSS + """,
named AS (SELECT unnest(['l_quantity', 'l_discount', 'l_tax', 'year', 'month', 'day', 'weekday', 'l_returnflag_N', 'l_returnflag_R', 'l_linestatus_O']) AS feature,
  round(unnest(b[2:]), 6) AS coefficient FROM fits WHERE f = -1)
SELECT * FROM named
""")
def ols(spark, folder):
    _, _, _, sums = sales_products(spark, folder)
    return features.weight_table(spark, sums.names, linear.ridge_weights(sums.total)[1:]).withColumn("coefficient", F.round("coefficient", 6))


def cross_validated(spark, folder, name):
    train, test, inputs, sums = sales_products(spark, folder)
    weights, alpha = linear.chosen(sums, lasso=name == "lasso")
    price = linear.predicted(inputs, weights)
    row = regression.scored(name, train.withColumn("prediction", price), test.withColumn("prediction", price), "l_extendedprice")
    return row.select("model", *[F.round(c, 9 if c.endswith("r2") else 6).alias(c) for c in row.columns[1:]], F.lit(float(alpha)).alias("alpha"))


@query("ridge_cv", _cross_validated_sql("ridge", regression.RIDGE_ALPHAS))
def ridge_cv(spark, folder):
    return cross_validated(spark, folder, "ridge")


@query("lasso_cv", _cross_validated_sql("lasso", regression.LASSO_ALPHAS))
def lasso_cv(spark, folder):
    return cross_validated(spark, folder, "lasso")


PRICING = {"numeric": ["p_size", "name_length"], "categories": ["p_brand", "p_type"], "flags": ["is_large", "is_even"]}


def pricing_rows(spark, folder):
    part = table(spark, folder, "part").withColumns({
        "name_length": F.length("p_name"), "is_large": (F.col("p_size") > 25).cast("int"),
        "is_even": (F.col("p_size") % 2 == 0).cast("int"),
        "price": F.col("p_retailprice") * (F.col("p_size") + 50) / 100})
    rows = settle(prepare.folds(prepare.holdout(part, "p_partkey"), "p_partkey"))
    return rows.filter(~F.col("is_test")), rows.filter("is_test")


def pricing_sets(spark, folder):
    train, test = pricing_rows(spark, folder)
    fitted = features.fit_features(train, **PRICING)
    return settle(fitted.transform(train)), fitted.transform(test), fitted


@query("rf_regress_grid")
def rf_regress_grid(spark, folder):
    """Every setting of the grid by 5-fold R²; the best one, refitted, with its scores on training and hold-out rows."""
    train, test = pricing_rows(spark, folder)
    inputs = boosting.plan_features(train, [*PRICING["numeric"], *PRICING["flags"]], onehot=PRICING["categories"])
    cells = boosting.cells_of(train, inputs, "price", "p_partkey", "fold")
    found = settle(regression.forest_search(cells, inputs))
    best = found.filter("is_best").first()
    model = boosting.fit_forest(cells, inputs, best["trees"], None if best["depth"] < 0 else best["depth"], best["split"])
    row = regression.scored("forest", model.predicted(train, "price"), model.predicted(test, "price"), "price")
    return found.join(row.withColumn("is_best", F.lit(True)), "is_best", "left")


@query("gbt_regress")
def gbt_regress(spark, folder):
    train, test, _ = pricing_sets(spark, folder)
    return regression.evaluated("boosting", regression.boosting(train, "price"), train, test, "price")


@query("feature_importance")
def feature_importance(spark, folder):
    train, _, fitted = pricing_sets(spark, folder)
    model = regression.boosting(train, "price")
    weights = features.weight_table(spark, fitted.names, model.featureImportances, "importance")
    return weights.orderBy(F.desc("importance"), "feature").limit(20)


@query("batch_score")
def batch_score(spark, folder):
    """Fit, save, reload, score the whole table in one job, with an interval per row."""
    train, _, fitted = pricing_sets(spark, folder)
    model = regression.ordinary(train, "price")
    path = new_folder(spark, "pricing-model")
    PipelineModel([*fitted.model.stages, model]).save(path)
    loaded = PipelineModel.load(path)
    cars = table(spark, folder, "part").withColumns({
        "name_length": F.length("p_name"), "is_large": (F.col("p_size") > 25).cast("int"),
        "is_even": (F.col("p_size") % 2 == 0).cast("int")})
    price = numbers.round_half_even(F.col("prediction"), 2)
    scored = loaded.transform(cars).select("p_partkey", "p_brand", "p_type", price.alias("predicted_price_per_day"))
    return scored.withColumns({
        "currency": F.lit("EUR"), "confidence_interval": numbers.price_interval(F.col("predicted_price_per_day"))})


@query("model_run_log")
def model_run_log(spark, folder):
    train, test, _ = pricing_sets(spark, folder)
    linear = regression.evaluated("linear", regression.ordinary(train, "price"), train, test, "price")
    boosted = regression.evaluated("boosting", regression.boosting(train, "price"), train, test, "price")
    compared = evaluate.compare_models(linear.unionByName(boosted), "model", "test_r2")
    entries = regression.run_log(compared.drop("is_best"), "pricing", {"boosting": regression.BOOSTING, "linear": {}})
    return regression.append_log(entries, new_folder(spark, "run-log"))


def visits(spark, folder):
    key, pages = F.col("o_orderkey"), F.col("o_orderkey") * 7 % 29
    age = F.col("o_custkey") % 50 + 17
    chance = pages * 2 - age / 5 + F.floor(F.col("o_totalprice") % 20)
    return table(spark, folder, "orders").select(
        key.alias("id"), F.col("o_orderstatus").alias("country"), F.col("o_orderpriority").alias("source"),
        (key % 2).cast("int").alias("new_user"), age.cast("int").alias("age"),
        pages.cast("int").alias("total_pages_visited"), (chance > 48).cast("int").alias("converted"))


def visit_rows(spark, folder):
    rows = prepare.visit_features(visits(spark, folder))
    split = prepare.holdout(rows, "id", by=["converted"])
    folded = settle(prepare.folds(split, "id", by=["converted"]))
    return folded.filter(~F.col("is_test")), folded.filter("is_test")


VISIT = ["age", "total_pages_visited", "new_user"]
VISIT_MORE = [*VISIT, "pages_per_age", "interaction_age_pages", "is_active"]
VISIT_CATEGORIES = ["country", "source"]
#: The score falls with age and rises with pages.
VISIT_DIRECTIONS = {"age": -1, "total_pages_visited": 1}


def visit_sets(spark, folder):
    train, test = visit_rows(spark, folder)
    fitted = features.fit_features(
        train, ["age", "total_pages_visited", "pages_per_age", "interaction_age_pages"], ["country", "source"],
        ["new_user", "is_active"])
    return settle(fitted.transform(train)), fitted.transform(test)


@query("gbt_classify")
def gbt_classify(spark, folder):
    train, test = visit_rows(spark, folder)
    inputs = boosting.plan_features(train, VISIT_MORE, onehot=VISIT_CATEGORIES)
    model = classification.boosted(train, "converted", "id", inputs)
    scored = settle(model.scored(test, "converted"))
    best = evaluate.best_threshold(evaluate.threshold_sweep(scored, "converted", "score"))
    return best.withColumn("roc_auc", evaluate.roc_auc(scored, "converted", "score").scalar())


@query("monotone_boosting")
def monotone_boosting(spark, folder):
    """Monotone boosted trees on the known rows, threshold from their scores, decisions on the others: written as a table and read back."""
    train, test = visit_rows(spark, folder)
    inputs = boosting.plan_features(train.unionByName(test), VISIT, ordinal=VISIT_CATEGORIES, directions=VISIT_DIRECTIONS)
    model = classification.boosted(train, "converted", "id", inputs, **classification.MONOTONE)
    best = evaluate.best_threshold(evaluate.threshold_sweep(settle(model.scored(train, "converted")), "converted", "score")).first()
    decided = model.scored(test, "id", F.col("converted").alias("truth")).withColumn("converted", (F.col("score") >= best["threshold"]).cast("int"))
    path = new_folder(spark, "submission")
    decided.write.parquet(path)
    return spark.read.schema(decided.schema).parquet(path).withColumns(
        {"threshold": F.lit(best["threshold"]), "train_f1": F.lit(best["f1"])})


@query("monotone_logit")
def monotone_logit(spark, folder):
    """Fit on the hold-out complement, choose the threshold, decide on the hold-out rows."""
    train, test = visit_sets(spark, folder)
    sources = {"country": ["F", "O", "P"], "source": ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]}
    model = classification.MonotoneLogit({"age": -1, "total_pages_visited": 1}, sources).fit(
        train.drop("features"), "converted")
    inside = model.transform(train.drop("features"))
    best = evaluate.best_threshold(evaluate.threshold_sweep(inside, "converted", "score")).first()["threshold"]
    return classification.submission(model.transform(test.drop("features")), "id", best)


@query("boosted_search")
def boosted_search(spark, folder):
    """All 72 settings of the monotone model with the mean of each fold's best F1."""
    train, _ = visit_rows(spark, folder)
    inputs = boosting.plan_features(train, VISIT, ordinal=VISIT_CATEGORIES, directions=VISIT_DIRECTIONS)
    return classification.search_boosted(boosting.cells_of(train, inputs, "converted", "id", "fold"), inputs)


@query("oof_average")
def oof_average(spark, folder):
    """Test rows by the average of the fold models plus rule score, decided by the out-of-fold threshold; its F1 and AUC."""
    train, test = visit_rows(spark, folder)
    return averaged(train, test)


def averaged(train, test, settings=None):
    inputs = boosting.plan_features(train, VISIT_MORE, onehot=VISIT_CATEGORIES)
    cells = boosting.cells_of(train, inputs, "converted", "id", "fold")
    inside, outside = classification.boosted_folds(train, test, cells, inputs, "id", settings=settings)
    final = lambda rows, scores: prepare.rule_score(rows.join(scores, "id"), train).withColumn(
        "score", prepare.boosted_score("score"))
    known = settle(final(train, inside).select("id", "converted", "score"))
    sweep = evaluate.threshold_sweep(known, "converted", "score", evaluate.linear_grid(0.05, 0.6, 500))
    best = evaluate.best_threshold(sweep).first()
    return final(test, outside).select(
        "id", "score", (F.col("score") >= best["threshold"]).cast("int").alias("converted"), F.lit(best["threshold"]).alias("threshold"),
        F.lit(best["f1"]).alias("oof_f1"), evaluate.roc_auc(known, "converted", "score").scalar().alias("oof_roc_auc"))


def messages(spark, folder):
    joined = table(spark, folder, "documents").join(table(spark, folder, "labels"), "doc_id")
    tokens = text.words(text.clean_message(F.col("text")))
    rows = joined.select("doc_id", "text", tokens.alias("tokens"), F.col("toxic").alias("label"))
    return settle(prepare.holdout(rows, "doc_id", by=["label"]))


def by_terms(rows):
    """Hold-out rows with the decision of the logistic model on term weights."""
    train = rows.filter(~F.col("is_test"))
    weights = settle(words.tfidf(rows, "doc_id", F.col("tokens"), max_features=5000, fit_on=train))
    vectors, _ = sparse_vectors(weights, "doc_id")
    known = vectors.join(rows.select("doc_id", "label", "is_test"), "doc_id")
    model = classification.text_logit(known.filter(~F.col("is_test")), "label")
    return model.transform(known.filter("is_test")).select("doc_id", "label", F.col("prediction").cast("int").alias("p"))


def by_word_vectors(rows):
    """Hold-out rows with the decision of the small net on word vectors."""
    train = rows.filter(~F.col("is_test"))
    vectors = Word2Vec(vectorSize=32, minCount=1, inputCol="tokens", outputCol="features", maxIter=15, seed=42).fit(train)
    model = classification.small_network(vectors.transform(train), "label", [32, 24, 2])
    return model.transform(vectors.transform(rows.filter("is_test"))).select("doc_id", "label", F.col("prediction").cast("int").alias("p"))


@query("logit_tfidf")
def logit_tfidf(spark, folder):
    return evaluate.class_report(by_terms(messages(spark, folder)), "label", "p")


@query("mlp_wordvec")
def mlp_wordvec(spark, folder):
    return evaluate.binary_metrics(by_word_vectors(messages(spark, folder)), "label", "p").withColumn("model", F.lit("word vectors"))


@query("message_study")
def message_study(spark, folder):
    """Fitted message models side by side on the same hold-out rows, the best marked, with the first wrong rows of each."""
    rows = messages(spark, folder)
    judged = settle(by_terms(rows).withColumn("model", F.lit("term weights")).unionByName(
        by_word_vectors(rows).withColumn("model", F.lit("word vectors"))))
    metrics = evaluate.compare_models(settle(evaluate.binary_metrics(judged, "label", "p", ["model"])), "model", "f1")
    wrong = selection.first_per_group(judged.filter("label != p"), ["model"], ["doc_id"], 5).groupBy("model").agg(
        F.sort_array(F.collect_list("doc_id")).alias("first_errors"))
    return metrics.join(wrong, "model", "left")


@query("mlp_embeddings")
def mlp_embeddings(spark, folder):
    vectors = table(spark, folder, "embeddings").select(
        "vec_id", "label", array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))
    rows = settle(prepare.holdout(vectors, "vec_id", by=["label"]))
    model = classification.small_network(rows.filter(~F.col("is_test")), "label", [64, 64, 32, 10])
    predicted = model.transform(rows.filter("is_test")).withColumn("p", F.col("prediction").cast("int"))
    return evaluate.class_report(predicted, "label", "p")


def pickups(spark, folder):
    """Event positions: (value, props.k)."""
    k = F.get_json_object("props", "$.k").cast("double")
    return table(spark, folder, "events").select("event_id", "ts", F.col("value").alias("lat"), k.alias("lon"))


def zones(spark, folder):
    points = pickups(spark, folder).withColumn("features", array_to_vector(F.array("lat", "lon")))
    model = grouping.centres(points, 10)
    return model, model.transform(points)


@query("kmeans_zones")
def kmeans_zones(spark, folder):
    model, _ = zones(spark, folder)
    return grouping.centre_table(spark, model, ["lat", "lon"])


@query("hot_zones_by_hour")
def hot_zones_by_hour(spark, folder):
    _, labelled = zones(spark, folder)
    return grouping.zone_counts(labelled, "cluster", "ts")


@query("rf_zone")
def rf_zone(spark, folder):
    """Zone from hour and weekday: importance of both and hold-out accuracy."""
    _, labelled = zones(spark, folder)
    timed = labelled.select(
        "event_id", F.col("cluster").alias("label"), F.hour("ts").alias("hour"), F.weekday("ts").cast("string").alias("weekday"))
    rows = settle(prepare.holdout(timed, "event_id"))
    train, test = rows.filter(~F.col("is_test")), rows.filter("is_test")
    fitted = features.fit_features(train, ["hour"], ["weekday"])
    model = classification.zone_forest(fitted.transform(train), "label")
    right = model.transform(fitted.transform(test)).select(F.avg((F.col("prediction") == F.col("label")).cast("double")))
    return features.weight_table(spark, fitted.names, model.featureImportances, "importance").withColumn(
        "accuracy", right.scalar())


def scaled_measures(spark, folder):
    rows = table(spark, folder, "lineitem").select("l_quantity", "l_extendedprice", "l_discount", "l_tax").dropna()
    fitted = features.fit_features(rows, rows.columns)
    return fitted.transform(rows), rows.columns


@query("pca2")
def pca2(spark, folder):
    scaled, names = scaled_measures(spark, folder)
    model = grouping.components(scaled)
    loadings = [(name, float(a), float(b)) for name, (a, b) in zip(names, model.pc.toArray(), strict=True)]
    shares = [float(v) for v in model.explainedVariance]
    return spark.createDataFrame(loadings, "feature string, pc1 double, pc2 double").withColumns(
        {"share_1": F.lit(shares[0]), "share_2": F.lit(shares[1])})


@query("kmeans_measures")
def kmeans_measures(spark, folder):
    scaled, _ = scaled_measures(spark, folder)
    model = grouping.centres(scaled, 3)
    return model.transform(scaled).groupBy("cluster").agg(F.count("*").alias("n"), F.avg("l_extendedprice").alias("mean_price"))


def topic_model(spark, folder):
    tokens = words.one_and_two_grams(text.clean_message(F.col("text")))
    weights = settle(words.tfidf(table(spark, folder, "documents"), "doc_id", tokens, 2, 0.85, 3000))
    return weights, grouping.topics(weights, "doc_id", 15)


@query("lsa_topics")
def lsa_topics(spark, folder):
    _, (strengths, _, summary) = topic_model(spark, folder)
    counts = grouping.main_topic(strengths, "doc_id").groupBy("topic").agg(F.count("*").alias("documents"))
    return summary.join(counts, "topic", "left")


@query("lsa_topic_terms")
def lsa_topic_terms(spark, folder):
    _, (_, by_term, _) = topic_model(spark, folder)
    return grouping.topic_terms(by_term, 10)
