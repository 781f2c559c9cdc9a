"""Mixing sources to target weights by systematic sampling, DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ferrolith.operators.ordering import hash_order, running_totals, sequential_ids
from ferrolith.session import settle

SPACES = r"[ \x09-\x0D]+"
#: Weights of the sources in their order, repeating, and the most copies of a document.
WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
#: Documents of one source and size that are numbered in one window; more are cut into ranges of their hash.
ROWS = 1024
#: Shares that the rows of one source and size are dealt into where the table of crowded ones, copied as often, is joined to them.
SHARES = 32


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text (long); null has none."""
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")).cast("long")


def sized_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(doc_id, source, size, _key, _row): word counts without the texts, settled.

    ``_key`` orders the sources by code point with null last and is never null;
    ``_row`` tells rows apart that share an id.
    """
    from_source = F.when(F.col(source).isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), F.col(source)))
    return settle(docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"),
        from_source.alias("_key"), F.monotonically_increasing_id().alias("_row")), "sized")


def source_targets(sized: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """(_key, source_size, target): words each source gives to the mix.

    The sizes of all sources are shared by weight. A source gives at most
    ``most`` times its size; what it can't give is shared again among the others
    until none is above. That is ``least(most * size, level * weight)`` at one
    common level, found from running totals over the sources in the order in
    which they fill up. One row per source; nothing is collected.
    """
    totals = settle(sized.groupBy("_key").agg(F.sum("size").alias("source_size")), "sources")
    place = sequential_ids(totals, "_key", "_place")
    turn = F.array(*[F.lit(w) for w in weights])
    weighed = settle(place.withColumn("_weight", F.get(turn, ((F.col("_place") - 1) % len(weights)).cast("int")).cast("long")).withColumn(
        "_cap", F.col("source_size") * most).withColumn("_full", F.col("_cap") / F.col("_weight")), "weighed")
    whole = weighed.agg(F.sum("source_size").alias("t"), F.sum("_weight").alias("w"))
    fills = running_totals(weighed.groupBy("_full").agg(F.sum("_cap").alias("caps"), F.sum("_weight").alias("weights")), "_full", ["caps", "weights"])
    sums = fills.withColumn("_whole", whole.select(F.struct("t", "w")).scalar())
    left = F.col("_whole.w") - F.col("cum_weights")
    short = F.col("cum_caps") + F.col("_full") * left < F.col("_whole.t")
    level = sums.filter(short & (left > 0)).agg(F.max_by((F.col("_whole.t") - F.col("cum_caps")) / left, F.col("_full")))
    first = whole.select(F.col("t") / F.col("w"))
    return settle(weighed.select("_key", "source_size", F.least(
        F.col("_cap").cast("double"), F.coalesce(level.scalar(), first.scalar()) * F.col("_weight")).alias("target")), "targets")


def _told(rows: DataFrame, crowded: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``rows`` left-joined with the small table ``crowded``; a hot key is spread over ``SHARES`` tasks."""
    copied = crowded.withColumn("_share", F.explode(F.sequence(F.lit(0), F.lit(SHARES - 1))))
    return rows.withColumn("_share", F.pmod(F.xxhash64("_row"), F.lit(SHARES)).cast("int")).join(copied, [*keys, "_share"], "left").drop("_share")


def _numbered(sized: DataFrame, seed: int, rows: int) -> DataFrame:
    """``sized`` with ``_place``: 1, 2, 3 … within the source, largest documents first, equal ones by hash of the id.

    A (source, size) with more than ``rows`` documents is cut into ranges of the
    hash, and a range that one repeated id fills is cut by row; each part is a
    small window, and one total per part is carried on.
    """
    cell = ["_key", "size"]
    crowded = sized.groupBy(*cell).agg(F.ceil(F.count("*") / rows).alias("_cuts")).filter("_cuts > 1")
    hashed = _told(sized.withColumn("_hash", hash_order(F.col("doc_id"), seed)), crowded, cell)
    at = F.conv(F.substring("_hash", 1, 8), 16, 10).cast("long")
    dealt = hashed.withColumn("_slice", F.shiftright(at * F.coalesce("_cuts", F.lit(1)), 32))
    repeated = dealt.filter("_cuts > 1").groupBy(*cell, "_slice").agg(F.count("*").alias("_n")).filter(F.col("_n") > 2 * rows)
    dealt = _told(dealt, repeated, [*cell, "_slice"]).withColumn(
        "_part", F.pmod(F.col("_row"), F.coalesce(F.ceil(F.col("_n") / rows), F.lit(1))))
    keys = [*cell, "_slice", "_part"]
    parts = dealt.repartition(*keys)
    inside = Window.partitionBy(*keys).orderBy("_hash", "doc_id", "_row")
    before = Window.partitionBy("_key").orderBy(F.desc("size"), "_slice", "_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = parts.groupBy(*keys).agg(F.count("*").alias("_rows")).select(*keys, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_shift"))
    local = parts.select("doc_id", "source", "_row", *keys, F.row_number().over(inside).alias("_in"))
    return local.join(shifts, keys).select("doc_id", "source", "size", "_key", (F.col("_in") + F.col("_shift")).alias("_place"))


def offset(key: Column, seed: int) -> Column:
    """The random start of a source, in [0, 1): 52 bits of an md5."""
    return F.conv(F.substring(F.md5(F.concat_ws("#", key, F.lit(str(seed)))), 1, 13), 16, 10).cast("double") / float(1 << 52)


def mix_copies(docs: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_COPIES, seed: int = 42, doc_id: str = "doc_id",
               text: str = "text", source: str = "source", rows: int = ROWS) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken), one row per document.

    Documents of a source stand one after the other by falling size, each as
    long as its expected copies (target / source size); a document gets one copy
    per whole number that its stretch crosses, counted from the source's random
    start. So its copies are the expected ones rounded down or up, never above
    ``most``, and the words a source gives miss its target by at most about the
    size of its largest document. ``taken`` is copies times size.

    Null or empty texts have size 0 and take nothing; a null source is a source
    of its own, the last. Rows with a null or repeated id are documents of their
    own. Without documents there are no rows. Other columns are not read.
    """
    sized = sized_documents(docs, doc_id, text, source)
    targets = source_targets(sized, weights, most)
    placed = _numbered(sized, seed, rows).join(targets, "_key")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    crossed = lambda place: F.floor(place * rate + F.col("_start"))
    copies = F.least(crossed(F.col("_place")) - crossed(F.col("_place") - 1), F.lit(most)).cast("int")
    return placed.withColumn("_start", offset(F.col("_key"), seed)).select(
        "doc_id", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def emit(docs: DataFrame, mixed: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The mix: each row of ``docs`` as often as ``mixed`` (of ``mix_copies``) says.

    Rows that share id, source and size are paired with their verdicts by number.
    """
    same = lambda *names: Window.partitionBy(*names).orderBy(names[-1])
    keyed = docs.withColumns({"_id": F.col(doc_id), "_source": F.col(source), "_size": word_count(F.col(text))})
    keyed = keyed.withColumn("_n", F.row_number().over(same("_id", "_source", "_size")))
    plan = mixed.select(F.col("doc_id").alias("_id2"), F.col("source").alias("_source2"), F.col("size").alias("_size2"), F.col("copies").alias("_copies"))
    plan = plan.withColumn("_n2", F.row_number().over(same("_id2", "_source2", "_size2"))).filter("_copies > 0")
    met = keyed.join(plan, F.col("_id").eqNullSafe(F.col("_id2")) & F.col("_source").eqNullSafe(F.col("_source2")) & (
        F.col("_size") == F.col("_size2")) & (F.col("_n") == F.col("_n2")))
    return met.select(*(F.col(f"`{c}`") for c in docs.columns), F.explode(F.sequence(F.lit(1), F.col("_copies"))).alias("_copy")).drop("_copy")


SQL = f"""
WITH d AS (SELECT doc_id, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS k,
  len(list_filter(regexp_split_to_array(coalesce(text, ''), '[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> ''))::BIGINT AS size FROM documents),
s AS (SELECT k, sum(size)::BIGINT AS source_size, CASE (row_number() OVER (ORDER BY k) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w FROM d GROUP BY k),
c AS (SELECT *, {MOST_COPIES} * source_size AS cap, (3 * source_size)::DOUBLE / w AS filled FROM s),
whole AS (SELECT sum(source_size)::BIGINT AS t, sum(w)::BIGINT AS w FROM c),
fills AS (SELECT filled, sum(cap) AS caps, sum(w) AS ws FROM c GROUP BY filled),
sums AS (SELECT filled, (sum(caps) OVER (ORDER BY filled))::BIGINT AS cum, (sum(ws) OVER (ORDER BY filled))::BIGINT AS cw FROM fills),
level AS (SELECT coalesce((SELECT max_by((t - cum)::DOUBLE / (whole.w - cw), filled) FROM sums, whole
    WHERE whole.w > cw AND cum + filled * (whole.w - cw) < t), (SELECT t::DOUBLE / w FROM whole)) AS lev),
targets AS (SELECT k, source_size, least(cap::DOUBLE, lev * w) AS target,
    ('0x' || substr(md5(k || '#42'), 1, 13))::BIGINT::DOUBLE / {1 << 52} AS start FROM c, level),
placed AS (SELECT d.*, source_size, target, start, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
    row_number() OVER (PARTITION BY d.k ORDER BY size DESC, md5(doc_id::VARCHAR || '#42'), doc_id) AS place FROM d JOIN targets USING (k))
SELECT doc_id, size, source_size, target, (floor(place * rate + start) - floor((place - 1) * rate + start))::BIGINT * size AS taken FROM placed
"""
