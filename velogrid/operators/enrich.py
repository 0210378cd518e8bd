"""Trips joined with rider data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPREAD = 512

#: A rider is hot beyond this part of the trips that one shuffle partition has in the mean.
HOT_PARTS = 16
USER_COLUMNS = ["edad_usuario", "fecha_alta", "hora_alta"]


def one_row_per_user(users: DataFrame) -> DataFrame:
    """The smallest row per id; the row is ordered as a struct, so any column set works."""
    rest = [c for c in users.columns if c != "id_usuario"]
    return (
        users.groupBy("id_usuario").agg(F.min(F.struct(*rest)).alias("_row")).select("id_usuario", *[f"_row.{c}" for c in rest])
    )


def hot_riders(trips: DataFrame, partitions: int | None = None) -> DataFrame:
    """(id_usuario, viajes, copias) of the riders with more trips than a sixteenth of a partition's mean; ``copias`` parts of that size hold theirs.

    One narrow aggregate, which combines before its shuffle. No more riders than ``HOT_PARTS * partitions`` can be hot, however many
    there are, so the result is small enough to be broadcast.
    """
    n = partitions or int(trips.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = trips.where("id_usuario is not null").groupBy("id_usuario").agg(F.count("*").alias("viajes"))
    most = trips.agg(F.count("*") / (HOT_PARTS * n)).scalar()
    hot = counts.withColumn("_tope", F.greatest(most, F.lit(1.0))).where("viajes > _tope")
    return hot.select("id_usuario", "viajes", F.ceil(F.col("viajes") / F.col("_tope")).alias("copias"))


def add_users_balanced(trips: DataFrame, users: DataFrame | None, dedupe: bool = False, partitions: int | None = None) -> DataFrame:
    """``add_users`` for trips whose hot riders nobody knows beforehand.

    The trips of a hot rider are split, and that rider's rows alone are copied, once per part; all others meet as
    they are. Trips without a rider are spread, as there.
    """
    if users is None:
        return trips
    wanted = users.select("id_usuario", *[c for c in USER_COLUMNS if c in users.columns])
    if dedupe:
        wanted = one_row_per_user(wanted)
    hot = F.broadcast(hot_riders(trips, partitions).select("id_usuario", "copias"))
    place = F.pmod(F.xxhash64("id_recorrido", "fecha_origen_recorrido"), F.lit(1 << 30))
    part = F.when(F.col("id_usuario").isNull(), F.pmod(place, F.lit(SPREAD))).otherwise(F.pmod(place, F.coalesce("copias", F.lit(1))))
    left = trips.join(hot, "id_usuario", "left").withColumn("_part", part.cast("bigint")).select(*trips.columns, "_part")
    known = wanted.where("id_usuario is not null").join(hot, "id_usuario", "left")
    right = known.withColumn("_part", F.explode(F.sequence(F.lit(0), F.coalesce("copias", F.lit(1)) - 1))).drop("copias")
    return left.join(right, ["id_usuario", "_part"], "left").drop("_part").select(*trips.columns, *[c for c in wanted.columns if c != "id_usuario"])


def add_users(trips: DataFrame, users: DataFrame | None, dedupe: bool = False, salt: int = 1) -> DataFrame:
    """Left join on the user id. Users are not unique across years, so trips may multiply unless
    ``dedupe`` is set. ``users=None`` adds nothing.

    Trips without a user cannot match, so they are spread over many partitions instead of meeting
    in the one for null. ``salt`` copies each user that often and spreads the trips of every user
    over as many partitions; a plan that broadcasts the users (Spark decides by their size) does
    not need it.
    """
    if users is None:
        return trips
    wanted = users.select("id_usuario", *[c for c in USER_COLUMNS if c in users.columns])
    if dedupe:
        wanted = one_row_per_user(wanted)
    place = F.pmod(F.xxhash64("id_recorrido", "fecha_origen_recorrido"), F.lit(SPREAD)).cast("int")
    left = trips.withColumn(
        "_part", F.when(F.col("id_usuario").isNull(), place).otherwise(F.pmod(place, F.lit(salt)).cast("int")).cast("bigint")
    )
    # Not the literal 0, which would be folded out of the join key.
    copies = F.pmod("id_usuario", F.lit(1)) if salt == 1 else F.explode(F.expr(f"sequence(0L, {salt - 1}L)"))
    right = wanted.filter("id_usuario is not null").withColumn("_part", copies)
    return left.join(right, ["id_usuario", "_part"], "left").drop("_part")
