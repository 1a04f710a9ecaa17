"""Delete propagation and key-based joins (J3, J4, J5, X6 batch form).

None of these joins carries a broadcast hint: the delete feed and the
device registry both grow with the user base.  Spark's adaptive execution
measures each side after its shuffle map stage and switches to a broadcast
join only when the measured side is under the broadcast threshold -- the
size check happens at run time, on real statistics.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.variant import header


def verify_inserted(bronze: DataFrame, staged: DataFrame, key: str = "record_id") -> DataFrame:
    """Bronze rows whose id is among the staged ids (left semi), counted."""
    return (bronze.select(key).join(staged.select(key), key, "left_semi")
            .agg(F.count(F.lit(1)).alias("verified_rows")))


def apply_deletes(facts: DataFrame, deletes: DataFrame, key: str, mode: str = "remove",
                  deleted_key: str = "deleted_uuid") -> DataFrame:
    """Drop (``remove``) or mark (``flag``) rows whose ``key`` was deleted.

    Order-free: a delete that lands before its sample still removes it.
    """
    d = deletes.select(F.col(deleted_key).alias("_deleted_key")).filter(F.col("_deleted_key").isNotNull())
    if mode == "remove":
        return facts.join(d, F.col(key) == F.col("_deleted_key"), "left_anti")
    if mode == "flag":
        flags = d.distinct().withColumn("is_deleted", F.lit(True))
        return (facts.join(flags, F.col(key) == F.col("_deleted_key"), "left")
                .withColumn("is_deleted", F.coalesce(F.col("is_deleted"), F.lit(False))).drop("_deleted_key"))
    raise ValueError(f"unknown mode {mode!r}")


def device_id() -> Column:
    """The device header, in either of the cases that clients send."""
    return F.coalesce(header("x-device-id"), header("X-Device-Id"))


def device_registry(bronze: DataFrame, exclude_device: str | None = None) -> DataFrame:
    """A devices dimension (device_id -> user_id) as registered devices would
    give it: for each device, the user it most recently reported for."""
    d = bronze.select(device_id().alias("device_id"), "user_id", "ingested_at")
    d = d.filter(F.col("device_id").isNotNull() & F.col("user_id").isNotNull())
    if exclude_device:
        d = d.filter(F.col("device_id") != F.lit(exclude_device))
    return d.groupBy("device_id").agg(F.max_by("user_id", F.struct("ingested_at", "user_id")).alias("device_user_id"))


def attribute_user_by_device(bronze: DataFrame, devices: DataFrame, exclude_device: str | None = None) -> DataFrame:
    """Resolve the user of each bronze row through its device; rows with
    an unknown device keep their own user_id.  Rows that cannot match (no device,
    or the one that the registry leaves out) are set apart before the join: they
    can be most of a table, and would all be shuffled to one or two partitions."""
    b = bronze.withColumn("device_id", device_id())
    can_match = F.col("device_id").isNotNull()
    if exclude_device is not None:
        can_match = can_match & (F.col("device_id") != exclude_device)
    j = b.filter(can_match).join(devices.select("device_id", "device_user_id"), "device_id", "left")
    matched = j.withColumn("resolved_user_id", F.coalesce(F.col("device_user_id"), F.col("user_id"))).drop("device_user_id")
    rest = b.filter(~F.coalesce(can_match, F.lit(False))).withColumn("resolved_user_id", F.col("user_id"))
    return matched.unionByName(rest)


def current_state(changes: DataFrame, deletes: DataFrame, key: str, order: tuple[str, ...] = ("ingested_at",),
                  deleted_key: str = "deleted_uuid") -> DataFrame:
    """X6 (batch form): latest version per key from an upsert log, minus keys
    with a delete.  ``max_by`` is a partial aggregate: hot keys are reduced
    map-side."""
    rest = [c for c in changes.columns if c != key]
    latest = (changes.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_v"))
              .select(key, "_v.*"))
    return apply_deletes(latest, deletes, key, "remove", deleted_key).select(*changes.columns)
