"""Plate access control: decisions, inconsistencies, resident registry, audit reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrolith.functions import text
from ferrolith.operators.ordering import previous_row
from ferrolith.operators.selection import first_row

AUTHORISED, REFUSED = "AUTHORISED", "REFUSED"
OPEN_STATUS = "open"


def one_per_plate(residents: DataFrame, key: str = "plaque") -> DataFrame:
    """One row per normalised plate: of several spellings the smallest text. A null plate is no plate."""
    row = F.struct(key, *[c for c in residents.columns if c != key])
    return residents.filter(F.col(key).isNotNull()).groupBy(text.plate_key(F.col(key)).alias("_plate")).agg(F.min(row).alias("_row")).select(
        *[F.col("_row").getField(c).alias(c) for c in residents.columns])


def decide(reads: DataFrame, residents: DataFrame, plate: str = "plate_number",
           confidence: str = "detection_confidence", least: float = 0.5) -> DataFrame:
    """Normalise the plates of confident reads and look them up.

    A plate is let in when a resident has it and their access is ``oui``.
    Plates that differ in spelling only are one resident, the one with the
    smallest plate text, so no read is multiplied; the planner broadcasts the
    registry only while it is small.
    """
    confident = reads.filter((F.col(confidence) >= least) & (F.trim(plate) != ""))
    keyed = confident.withColumn("normalized_plate", text.plate_key(F.col(plate)))
    known = one_per_plate(residents).select(
        text.plate_key(F.col("plaque")).alias("normalized_plate"), F.col("marque").alias("expected_brand"),
        F.col("nom").alias("resident_name"), "acces")
    joined = keyed.join(known, "normalized_plate", "left")
    allowed = F.coalesce(F.col("acces") == "oui", F.lit(False))
    return joined.withColumn("decision", F.when(allowed, AUTHORISED).otherwise(REFUSED))


def brand_mismatches(decided: DataFrame, brand: str = "brand") -> DataFrame:
    """Known plates whose detected brand differs from the declared one (no brand read: no mismatch)."""
    differs = F.upper(F.trim(brand)) != F.upper(F.trim("expected_brand"))
    return decided.filter(differs).withColumn("status", F.lit(OPEN_STATUS))


def audit_log(decided: DataFrame, plate: str = "plate_number", moment: str = "timestamp") -> DataFrame:
    return decided.select(
        F.col(plate).alias("plaque"), F.col(moment).alias("timestamp"), F.col("decision").alias("resultat"),
        "normalized_plate")


def history(log: DataFrame, plate: str) -> DataFrame:
    """All passages of one plate, latest first."""
    wanted = text.plate_key(F.lit(plate))
    return log.filter(F.col("normalized_plate") == wanted).orderBy(F.desc("timestamp"))


def latest(log: DataFrame, n: int = 50) -> DataFrame:
    return log.orderBy(F.desc("timestamp"), "normalized_plate").limit(n)


def resident_indicators(residents: DataFrame) -> DataFrame:
    active = F.col("acces") == "oui"
    return residents.agg(
        F.count("*").alias("total"), F.count_if(active).alias("active"),
        F.count_if(~F.coalesce(active, F.lit(False))).alias("blocked"),
        F.count_if(F.col("abonnement") == "oui").alias("subscribers"))


def apply_changes(residents: DataFrame, changes: DataFrame, key: str = "plaque", order: str = "seq") -> DataFrame:
    """Next registry snapshot from the current one and a batch of changes.

    ``changes`` has the registry columns plus ``op`` (add, delete, toggle)
    and an ascending ``order``. Spellings of one plate are one plate. Per plate the last add or delete decides
    whether and with which values it exists; toggles after it flip the
    access. An add for a plate that exists at that moment is rejected, as
    the plate is unique. Everything is a grouped minimum, maximum or count,
    so a plate with very many changes is reduced before the shuffle.
    """
    columns = residents.columns
    start = F.lit(-(2**62))
    current = one_per_plate(residents, key).select(*columns, F.lit("add").alias("op"), start.alias("_seq"))
    steps = current.unionByName(changes.select(*columns, "op", F.col(order).cast("long").alias("_seq"))).withColumn(
        "_plate", text.plate_key(F.col(key)))
    deleted = steps.filter("op = 'delete'").groupBy("_plate").agg(F.max("_seq").alias("_gone"))
    alive = steps.join(deleted, "_plate", "left").filter(F.col("_gone").isNull() | (F.col("_seq") > F.col("_gone")))
    born = alive.filter("op = 'add'").groupBy("_plate").agg(
        F.min("_seq").alias("_born"), F.min_by(F.struct(*columns), F.struct("_seq", key)).alias("_row"))
    flips = (
        alive.filter("op = 'toggle'").join(born.select("_plate", "_born"), "_plate")
        .filter(F.col("_seq") > F.col("_born")).groupBy("_plate").agg((F.count("*") % 2).alias("_odd"))
    )
    state = born.join(flips, "_plate", "left")
    access = F.col("_row.acces")
    flipped = F.when(access == "oui", "non").otherwise("oui")
    values = {c: F.col("_row").getField(c) for c in columns}
    values["acces"] = F.when(F.col("_odd") == 1, flipped).otherwise(access)
    return state.select(*[values[c].alias(c) for c in columns])


def correction_feed(inconsistencies: DataFrame) -> DataFrame:
    """Inconsistencies an administrator has corrected, as labelled training rows."""
    return inconsistencies.filter(F.col("corrected_brand").isNotNull() & (F.trim("corrected_brand") != "")).select(
        "image_path", F.col("corrected_brand").alias("label"),
        F.from_json("box_json", "x1 double, y1 double, x2 double, y2 double").alias("box"),
        "plaque", "timestamp", F.to_date("timestamp").alias("day"))


def one_read_per_passage(reads: DataFrame, key: str, moment: str, row_id: str, minutes: int = 5) -> DataFrame:
    """First read of each plate per time slot (batch form of duplicate suppression)."""
    slot = F.floor(F.unix_micros(F.col(moment).cast("timestamp")) / (minutes * 60_000_000))
    return first_row(reads.withColumn("_slot", slot), [key, "_slot"], [moment, row_id]).drop("_slot")


def passages(reads: DataFrame, key: str, moment: str, row_id: str, minutes: int = 5) -> DataFrame:
    """The first read of each passage: no other of the plate lies within ``minutes`` before it.

    Batch form of the session stream; a frequent plate's reads are cut by time, so
    that it does not fill a task.
    """
    timed = reads.withColumn("_at", F.col(moment).cast("timestamp"))
    linked = previous_row(timed, key, "_at", row_id, [])
    apart = F.unix_micros("_at") - F.unix_micros("prev__at") > minutes * 60_000_000
    return linked.filter(F.col("prev__at").isNull() | apart).drop("_at", "prev__at")
