"""Quality rules: text counts and a hashed n-gram log-likelihood ratio, DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferrolith.operators.ordering import running_totals
from ferrolith.session import bounded, settle

SPACES = r"[ \x09-\x0D]+"
#: Hash buckets of the two multinomials.
BUCKETS = 10_000
#: Low bits of a packed window that hold its place; longer texts pack into a struct instead.
PLACE_BITS = 20
#: Bits of a bucket in a packed pair of buckets.
GRAM_BITS = 15


def words_of(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; null gives an empty list."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")


def _hash3(at: Column) -> Column:
    h = F.col("_hashes")
    return F.xxhash64(F.get(h, at), F.get(h, at + 1), F.get(h, at + 2))


def _grams(buckets: int) -> Column:
    """Hash buckets of each word (high bits) and of the pair it begins (low bits); the last word pairs with nothing."""
    h = F.col("_hashes")
    bucket = lambda x: F.pmod(x, F.lit(buckets)).cast("int")
    return F.transform(h, lambda a, i: F.shiftleft(bucket(a), GRAM_BITS).bitwiseOR(bucket(F.xxhash64(a, F.get(h, i + 1)))))


def _first(gram: Column) -> Column:
    return F.shiftright(gram, GRAM_BITS)


def _second(gram: Column) -> Column:
    return gram.bitwiseAND(F.lit((1 << GRAM_BITS) - 1))


def _same_words(i: Column, j: Column) -> Column:
    w = F.col("_words")
    return (F.get(w, i) == F.get(w, j)) & (F.get(w, i + 1) == F.get(w, j + 1)) & (F.get(w, i + 2) == F.get(w, j + 2))


def _repeat_places() -> Column:
    """Places of the 3-word windows that occur again, from the column ``_windows``.

    Windows are sorted by hash, so equal ones are neighbours; neighbours count
    only if their words are equal.
    """
    s = F.col("_windows")
    place = lambda x: x.bitwiseAND(F.lit((1 << PLACE_BITS) - 1).cast("long")).cast("int")
    alike = F.zip_with(s, F.slice(s, F.lit(2), F.size(s)), lambda a, b: F.when(
        F.shiftright(a.bitwiseXOR(b), PLACE_BITS) == 0, F.array(place(a), place(b))))
    return F.sort_array(F.array_distinct(F.flatten(F.filter(alike, lambda p: _same_words(p[0], p[1])))))


def _repeat_places_long() -> Column:
    """The same for texts of any length: windows as (hash, place) structs."""
    s = F.sort_array(F.transform(F.sequence(F.lit(0), F.size("_words") - 3), lambda i: F.struct(_hash3(i).alias("h"), i.alias("i"))))
    alike = F.zip_with(s, F.slice(s, F.lit(2), F.size(s)), lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])))
    return F.sort_array(F.array_distinct(F.flatten(F.filter(alike, lambda p: _same_words(p[0], p[1])))))


def with_counts(docs: DataFrame, text: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """``docs`` with ``_grams`` (hash buckets of words and word pairs) and the base counts (all long).

    ``n_words``, ``word_chars`` (code points in words), ``n_symbols`` (of
    ``#*$%&|<>``), ``n_dup_lines`` (lines with a word, equal to an earlier line)
    and ``n_repeat_words`` (words inside 3-word windows found twice or more).
    All is computed inside the row, nothing is shuffled. Null text: zeros.
    """
    if buckets > 1 << GRAM_BITS:
        raise ValueError(f"at most {1 << GRAM_BITS} buckets")
    t = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^ \x09-\x0D]"))
    out = docs.withColumn("_words", words_of(F.col(text))).withColumn("_hashes", F.transform("_words", lambda a: F.xxhash64(a)))
    n = F.size("_words")
    short = n < (1 << PLACE_BITS)
    windows = F.transform(F.slice("_hashes", F.lit(1), F.greatest(n - 2, F.lit(0))), lambda a, i: F.xxhash64(
        a, F.get(F.col("_hashes"), i + 1), F.get(F.col("_hashes"), i + 2)))
    out = out.withColumn("_windows", F.when(short, windows)).withColumn("_grams", _grams(buckets))
    # most short texts repeat no window; only the others are sorted
    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    out = out.withColumn("_windows", F.when(repeats, F.sort_array(F.transform(
        "_windows", lambda h, i: F.shiftleft(h, PLACE_BITS).bitwiseOR(i.cast("long"))))))
    out = out.withColumn("_places", F.when(F.col("_windows").isNotNull(), _repeat_places()).when(
        ~short, _repeat_places_long()).otherwise(F.array().cast("array<int>")))
    p = F.col("_places")
    covered = F.aggregate(p, F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n")), lambda s, x: F.struct(
        x.alias("last"), (s["n"] + F.least(F.lit(3), x - s["last"])).alias("n")), lambda s: s["n"])
    # An outer generator of one row: a later filter on the counts stays above it, instead of being
    # pushed down with every list expression written out again.
    return out.withColumn("_lines", lines).select(*(F.col(f"`{c}`") for c in docs.columns), "_grams", F.inline_outer(F.array(F.struct(
        n.cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace(t, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        covered.cast("long").alias("n_repeat_words")))))


def base_failed(min_words: int = 50, repeat_percent: int = 50) -> Column:
    return (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > repeat_percent * F.col("n_words"))


def labelled_sample(labels: DataFrame, doc_id: str = "doc_id", quality: str = "quality") -> DataFrame:
    """(_id, _good) of all labelled ids; contradictory labels count as bad."""
    return labels.filter(F.col(doc_id).isNotNull() & F.col(quality).isNotNull()).groupBy(F.col(doc_id).alias("_id")).agg(
        F.min(quality).alias("_good"))


def with_labels(counted: DataFrame, sample: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """``counted`` with ``_good``: 1 for rows the sample calls good, 0 for its other rows, null for rows without label; once is enough.

    With a settled column ``_row`` (``monotonically_increasing_id``) only ids
    meet the labels; the answers come back as bits, one row for 64 of them, so
    that neither the labels are broadcast nor the rows shuffled.
    """
    if "_good" in counted.columns:
        return counted
    own = sample.select("_id", F.col("_good").eqNullSafe(1).cast("int").alias("_good"))
    if "_row" not in counted.columns:
        return counted.join(own, counted[doc_id] == own["_id"], "left").drop("_id")
    word, place = F.shiftright("_row", 6), F.col("_row").bitwiseAND(F.lit(63)).cast("int")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), place)
    bits = settle(counted.select("_row", F.col(doc_id).alias("_id")).join(own, "_id").groupBy(word.alias("_word")).agg(
        F.bit_or(bit).alias("_labelled"), F.bit_or(F.when(F.col("_good") == 1, bit)).alias("_goods")), "labelled")
    has = lambda mask: F.coalesce(F.call_function("getbit", F.col(mask), place), F.lit(0)).cast("int")
    return counted.withColumn("_word", word).join(bounded(bits), "_word", "left").withColumn(
        "_good", F.when(has("_labelled") == 1, has("_goods"))).drop("_word", "_labelled", "_goods")


def fit_ratios(counted: DataFrame, sample: DataFrame, doc_id: str = "doc_id", buckets: int = BUCKETS) -> list[float]:
    """Log ratio of each hash bucket: trusted target against raw corpus.

    ``counted`` comes from ``with_counts`` with the same ``buckets``. The raw
    multinomial counts words and word pairs of all documents, the trusted one
    those of documents the sample calls good; both add one to each bucket.
    Counts are summed before the shuffle, which carries at most one row per
    bucket and task. Without documents or labels all ratios are 0.
    """
    rows = with_labels(counted, sample, doc_id)
    pairs = rows.select(F.col("_good").eqNullSafe(1).cast("long").alias("_good"), F.explode("_grams").alias("_gram"))
    grams = pairs.select("_good", F.stack(F.lit(2), _first(F.col("_gram")), _second(F.col("_gram"))).alias("_bucket"))
    counts = grams.groupBy("_bucket").agg(F.count("*").alias("raw"), F.sum("_good").alias("good"))
    every = counted.sparkSession.range(buckets).select(F.col("id").cast("int").alias("_bucket")).join(counts, "_bucket", "left").select(
        "_bucket", (F.coalesce("raw", F.lit(0)) + 1).alias("raw"), (F.coalesce("good", F.lit(0)) + 1).alias("good"))
    table = every.groupBy().agg(F.array_sort(F.collect_list(F.struct("_bucket", "raw", "good"))).alias("by"),
                                F.sum("raw").alias("raws"), F.sum("good").alias("goods"))
    return table.select(F.transform("by", lambda x: F.log(x["good"] / F.col("goods")) - F.log(x["raw"] / F.col("raws"))).alias(
        "ratios")).first()["ratios"]


def with_ratio(counted: DataFrame, ratios: list[float]) -> DataFrame:
    """``counted`` (with ``_grams``) with ``ratio``: mean log ratio over its words and word pairs, 0 without any."""
    table = F.split(F.lit(",".join(map(repr, ratios))), ",").cast("array<double>")  # folds into one literal
    total = F.aggregate("_grams", F.lit(0.0), lambda total, g: total + (F.get(table, _first(g)) + F.get(table, _second(g))))
    ratio = F.when(F.size("_grams") > 0, total / (2 * F.size("_grams"))).otherwise(F.lit(0.0))
    return counted.select("*", F.inline_outer(F.array(F.struct(ratio.alias("ratio")))))  # as in with_counts: filters stay above


def fit_threshold(scored: DataFrame) -> float | None:
    """The ratio that parts good from bad labelled rows best, midway between the ratios next to the cut.

    ``scored`` has ``_good`` (see ``with_labels``), ``ratio`` and ``base_failed``;
    rows without label and those that fail the base are left out. Rows are
    counted by ratio, and running totals by ranges of it give both sides of each
    cut. None (keep all) if a class has no rows.
    """
    points = settle(scored.filter(F.col("_good").isNotNull() & ~F.col("base_failed")).groupBy("ratio").agg(
        F.sum("_good").alias("good"), F.sum(1 - F.col("_good")).alias("bad")), "ratios")
    goods, bads = points.agg(F.sum("good"), F.sum("bad")).first()
    if not goods or not bads:
        return None
    best = running_totals(points, "ratio", ["good", "bad"]).orderBy(
        F.desc(F.col("cum_bad") / F.lit(bads) - F.col("cum_good") / F.lit(goods)), "ratio").first()["ratio"]
    above = points.filter(F.col("ratio") > best).agg(F.min("ratio")).first()[0]
    return (best + (best if above is None else above)) / 2


def quality_rules(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  buckets: int = BUCKETS, carry_text: bool = True) -> DataFrame:
    """``docs`` with the counts of ``with_counts``, ``base_failed``, ``ratio``, ``threshold`` and ``kept``.

    ``kept`` is false if the base fails, else ``ratio >= threshold``; every row
    gets a verdict. Null or empty text fails the base; repeated rows get equal
    verdicts; a null id is judged like any other. Result columns replace input columns of the same name.
    Counts and hash buckets are settled once, so that texts are split a single
    time; ``carry_text=False`` leaves the text out of that table and of the result.
    """
    names = {"n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "ratio", "threshold", "base_failed", "kept",
             "_words", "_hashes", "_windows", "_grams", "_places", "_lines", "_row", "_word", "_labelled", "_goods", "_good"}
    docs = docs.select(*(F.col(f"`{c}`") for c in docs.columns if c not in names - {doc_id, text}))
    counted = with_counts(docs, text, buckets).withColumn("base_failed", base_failed())
    counted = settle((counted if carry_text else counted.drop(text)).withColumn("_row", F.monotonically_increasing_id()), "counted")
    sample = labelled_sample(labels)
    labelled = with_labels(counted, sample, doc_id)
    ratios = fit_ratios(labelled, sample, doc_id, buckets)
    threshold = fit_threshold(with_ratio(labelled.filter(F.col("_good").isNotNull() & ~F.col("base_failed")), ratios))
    return with_ratio(counted, ratios).drop("_grams", "_row").withColumn("threshold", F.lit(threshold).cast("double")).withColumn(
        "kept", ~F.col("base_failed") & F.coalesce(F.col("ratio") >= F.col("threshold"), F.lit(True)))
