"""How filters interact: which documents each prefix of each order keeps, removes, and finds removed already."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Mapping
from functools import reduce
from itertools import permutations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ferrolith.session import settle

#: Limits of the five rules, and the characters of the fourth.
MIN_WORDS, DISTINCT_PERCENT, CAPITALS_PERCENT, SYMBOLS = 50, 65, 5, b"#$%&*|"
CAPITALS = bytes(range(65, 91))


def text_rules(data: bytes) -> int:
    """Bits of the text rules A-D that a UTF-8 text fails."""
    words = data.split()  # bytes split at the ASCII white space, which is that of [^\x20\x09-\x0D]+
    capitals = len(data) - len(data.translate(None, CAPITALS))
    return ((len(words) < MIN_WORDS)
            | (100 * len(set(words)) < DISTINCT_PERCENT * len(words)) << 1
            | (100 * capitals > CAPITALS_PERCENT * len(data.decode())) << 2
            | (len(data.translate(None, SYMBOLS)) < len(data)) << 3)


def judged_rows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """(row, doc_id, part, digest, bits) of every document, settled; texts are read once and left behind.

    ``row`` tells rows apart that share an id or have none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).cast(pa.binary()).to_pylist()
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array([hashlib.blake2b(t, digest_size=16).digest() for t in texts], pa.binary()),
                pa.array(map(text_rules, texts), pa.int32())], names=["doc_id", "part", "digest", "bits"])

    plain = docs.select(F.col(doc_id).cast("long"), F.coalesce(F.col(part), F.lit("")), F.coalesce(F.col(text), F.lit("")))
    judged = plain.mapInArrow(run, "doc_id long, part string, digest binary, bits int")
    return settle(judged.select(F.monotonically_increasing_id().alias("row"), "*"), "judged")


def failing_ids(rows: DataFrame) -> dict[str, DataFrame]:
    """One settled table (row, doc_id, part) per filter A-E of the rows that fail it.

    E: equal to the text of a smaller id, which is every row of a text but those
    with its smallest id. A null id is neither smaller nor larger than another.
    """
    known = rows.filter("doc_id is not null")
    firsts = known.groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
    failing = {name: rows.filter(F.col("bits").bitwiseAND(F.lit(1 << i)) != 0) for i, name in enumerate("ABCD")}
    failing["E"] = known.join(firsts, ["digest", "doc_id"], "left_anti")
    return {name: settle(ids.select("row", "doc_id", "part"), f"fails-{name}") for name, ids in failing.items()}


def _holds(prefix: Column | str, bit: Column | int) -> Column:
    return (F.col(prefix) if isinstance(prefix, str) else prefix).bitwiseAND(bit) != 0


def interaction_audit(rows: DataFrame, failing: Mapping[str, DataFrame], marked: Mapping[str, DataFrame]) -> DataFrame:
    """One row per part, order of the filters and step, with its document counts.

    ``rows`` has (row, part), ``failing`` one id table per filter (one letter
    each), ``marked`` id tables whose members are counted as ``<name>_lost``.
    What a prefix keeps depends only on the set of its filters, so survivors are
    kept per set: each filter doubles the sets of a row and left-anti joins its
    id table to those that hold it. Removals are the survivors left-semi joined
    to the next filter's ids, redundancies the failing ids left-anti joined to
    the survivors. Rows that fail nothing are set aside first and only counted.
    Every join is on ``row``, which is unique: nothing is skewed, and the sets
    are made after the shuffle. Id tables grow with the documents, so both sides
    are always dealt by row: none travels through the driver to all tasks.
    Without rows the result is empty.
    """
    names = list(failing)
    n = len(names)
    dealt = lambda ids: ids.hint("shuffle_hash")
    sets = range(1 << n)
    every = reduce(DataFrame.unionByName, [ids.select("row", "part", F.lit(i).alias("f")) for i, ids in enumerate(failing.values())])
    hit = every.select("row").distinct()
    failed = settle(rows.select("row", "part").join(dealt(hit), "row", "left_semi"), "failed")

    kept = failed.withColumn("done", F.lit(0))
    for i, ids in enumerate(failing.values()):
        doubled = kept.select("row", "part", F.explode(F.array("done", F.col("done").bitwiseOR(F.lit(1 << i)))).alias("done"))
        gone = ids.select(F.col("row").alias("_row"))
        kept = doubled.join(dealt(gone), (F.col("row") == F.col("_row")) & _holds("done", F.lit(1 << i)), "left_anti")

    open_filters = F.array_compact(F.array(*[F.when(~_holds("done", F.lit(1 << i)), F.lit(i)) for i in range(n)]))
    waiting = kept.select("row", "part", "done", F.explode(open_filters).alias("f"))
    theirs = every.select(F.col("row").alias("_row"), F.col("f").alias("_f"))
    # differences instead of equalities: the join key stays the row alone, whose partitioning all joins share
    removed = waiting.join(dealt(theirs), (F.col("row") == F.col("_row")) & (F.col("f") - F.col("_f") == 0), "left_semi")
    lost = {name: removed.join(dealt(ids.select("row")), "row", "left_semi") for name, ids in marked.items()}
    bit = F.get(F.array(*[F.lit(1 << i) for i in range(n)]), F.col("f"))
    before = F.filter(F.array(*map(F.lit, sets)), lambda s: s.bitwiseAND(bit) == 0)
    asked = every.select("row", "part", F.explode(before).alias("done"), "f")
    there = kept.select(F.col("row").alias("_row"), F.col("done").alias("_done"))
    redundant = asked.join(dealt(there), (F.col("row") == F.col("_row")) & (F.col("done") - F.col("_done") == 0), "left_anti")
    alone = every.join(dealt(theirs), (F.col("row") == F.col("_row")) & (F.col("f") - F.col("_f") != 0), "left_anti")

    counted = {"kept": kept.select("part", "done", F.lit(-1).alias("f")), "removed": removed, "redundant": redundant,
               **{f"{name}_lost": ids for name, ids in lost.items()}, "unique_fails": alone.withColumn("done", F.lit(-1))}
    counts = settle(reduce(DataFrame.unionByName, [
        ids.groupBy("part", "done", "f").agg(F.count("*").alias("n")).withColumn("kind", F.lit(kind)) for kind, ids in counted.items()]), "audit")

    clean = rows.select("row", "part").join(dealt(hit), "row", "left_anti").groupBy("part").agg(F.count("*").alias("clean"))
    parts = rows.select("part").distinct().join(clean, "part", "left")
    orders = F.split(F.lit(",".join("".join(order) for order in permutations(names))), ",")
    steps = parts.select("part", "clean", F.explode(orders).alias("filter_order")).select(
        "*", F.explode(F.sequence(F.lit(1), F.lit(n))).alias("step"))
    place = lambda i: F.instr("filter_order", names[i])
    steps = steps.withColumn("done", sum((F.when(place(i) < F.col("step"), 1 << i).otherwise(0) for i in range(n)), F.lit(0))).withColumn(
        "f", sum((F.when(place(i) == F.col("step"), i).otherwise(0) for i in range(n)), F.lit(0)))
    steps = steps.withColumn("after", F.col("done").bitwiseOR(bit))

    def of(*kinds: str) -> list[Column]:
        return [F.sum(F.when(F.col("kind") == kind, F.col("n")).otherwise(0)).alias(kind) for kind in kinds]

    at_step = ["removed", "redundant", *(f"{name}_lost" for name in marked)]
    cells = counts.filter(F.col("kind").isin(*at_step)).groupBy("part", "done", "f").agg(*of(*at_step))
    single = counts.filter("kind = 'unique_fails'").groupBy("part", "f").agg(*of("unique_fails"))
    left = counts.filter("kind = 'kept'").select("part", F.col("done").alias("after"), F.col("n").alias("_kept"))
    zero = lambda name: F.coalesce(name, F.lit(0)).cast("long")
    table = steps.join(cells, ["part", "done", "f"], "left").join(single, ["part", "f"], "left").join(left, ["part", "after"], "left")
    return table.select(
        "part", "filter_order", F.col("step").cast("int").alias("step"), (zero("clean") + zero("_kept")).alias("kept"),
        *(zero(name).alias(name) for name in at_step), zero("unique_fails").alias("unique_fails"),
        F.sum(zero("removed")).over(Window.partitionBy("part", "f")).alias("shapley"))


def audit_documents(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """The audit of the five text filters over ``docs`` with good (quality = 1) and toxic (toxic = 1) documents lost.

    A null text is empty, a null part is the empty string. Rows that share an
    id are documents of their own and share its labels; a null id has none and
    fails no duplicate filter. Other columns are not read.
    """
    rows = judged_rows(docs, doc_id, text, part)
    has = lambda column: settle(rows.join(
        labels.filter(F.col(column) == 1).select(F.col("doc_id").cast("long")).hint("merge"), "doc_id", "left_semi").select("row"), column)
    return interaction_audit(rows, failing_ids(rows), {"good": has("quality"), "toxic": has("toxic")})


SQL = """
WITH t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(t, '[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> '') AS w FROM t),
m AS (SELECT part, (len(w) < 50)::INT + 2 * (100 * len(list_distinct(w)) < 65 * len(w))::INT
    + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t))::INT + 8 * regexp_matches(t, '[#$%&*|]')::INT
    + 16 * (doc_id > min(doc_id) OVER (PARTITION BY t))::INT AS m,
    (doc_id IN (SELECT doc_id FROM labels WHERE quality = 1))::INT AS good, (doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1))::INT AS toxic FROM w),
cells AS (SELECT part, m, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY part, m),
l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l),
orders AS (SELECT a.l || b.l || c.l || d.l || e.l AS o FROM l a, l b, l c, l d, l e
  WHERE len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5),
steps AS (SELECT o, s::INT AS step, 1 << (instr('ABCDE', o[s]) - 1) AS bit,
    list_sum([0] || list_transform(range(1, s), lambda i: 1 << (instr('ABCDE', o[i]) - 1)))::INT AS done FROM orders, range(1, 6) r(s)),
counts AS (SELECT part, o AS filter_order, step, bit, sum(CASE WHEN m & (done | bit) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
    sum(CASE WHEN m & done = 0 AND m & bit <> 0 THEN n ELSE 0 END)::BIGINT AS removed,
    sum(CASE WHEN m & done <> 0 AND m & bit <> 0 THEN n ELSE 0 END)::BIGINT AS redundant,
    sum(CASE WHEN m & done = 0 AND m & bit <> 0 THEN good ELSE 0 END)::BIGINT AS good_lost,
    sum(CASE WHEN m & done = 0 AND m & bit <> 0 THEN toxic ELSE 0 END)::BIGINT AS toxic_lost,
    sum(CASE WHEN m = bit THEN n ELSE 0 END)::BIGINT AS unique_fails FROM cells, steps GROUP BY ALL)
SELECT * EXCLUDE (bit), (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley FROM counts
"""
