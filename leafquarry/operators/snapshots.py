"""What changed between consecutive full snapshots of a table.

In the step from the previous delivered snapshot a record counts +1, in the step to the next one -1. Records are
unpivoted into signed cells (step, key, field, value) plus a key-presence marker. Sums of a cell that are not zero are
the differences: on the presence marker they mean an added or removed record, on field cells alone a changed one, and
they name the changed fields. Values are compared as they are, not by hashes. One shuffle dedupes the deliveries and one
brings the two sides of a record together before they are unpivoted, so cells never travel; both are keyed by record.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

SALTS = 16


def latest(df: DataFrame, keys: Sequence[str], at: str, values: Sequence[str]) -> DataFrame:
    """One row per key: the row delivered last; among equal times the greatest values hold."""
    best = F.max(F.struct(F.col(at).alias("_at"), *[F.col(v) for v in values])).alias("_best")
    known = df.where(" and ".join(f"`{k}` is not null" for k in keys))
    return known.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_best.{v}").alias(v) for v in values])


def _written(value: Column, kind: T.DataType) -> Column:
    """A value as text, so that values of all fields share one column; equal text means an equal value of the field."""
    if isinstance(kind, T.BinaryType):
        return F.base64(value)
    nested = isinstance(kind, (T.ArrayType, T.StructType, T.MapType))
    return F.to_json(F.struct(value)) if nested else value.cast("string")


def snapshot_changes(
    entries: DataFrame,
    series: str,
    snapshot: str,
    key: str,
    fields: Mapping[str, Column],
    delivered: str,
) -> DataFrame:
    """Changes from each delivered snapshot of a series to the next delivered one.

    entries: rows (series, snapshot number, record key, field columns, delivery time) in any order; of several rows
    of one record the latest delivery holds. fields: name and comparison form of each compared field; null is a value.
    Result: series, snapshot (the later of the two), key, change_type added / removed / changed, changed_fields.
    The first snapshot of a series gives no rows. Rows with a null series, snapshot or key name no record and are
    left out; an empty table gives an empty result; extra columns are ignored.
    """
    raw = entries.select(
        F.col(series).alias("series"), F.col(snapshot).alias("snap"), F.col(key).alias("rec"),
        F.col(delivered).alias("delivered"), *[c.alias(f"v_{n}") for n, c in fields.items()],
    )
    rows = latest(raw, ["series", "snap", "rec"], "delivered", [f"v_{n}" for n in fields])
    # One row per delivered snapshot of a series, copied per salt so that one large series spreads over the join.
    steps = (
        raw.where("series is not null and snap is not null and rec is not null")
        .groupBy("series", "snap")
        .agg(F.lit(1).alias("_one"))
        .withColumn("next", F.lead("snap").over(Window.partitionBy("series").orderBy("snap")))
        .withColumn("first", F.min("snap").over(Window.partitionBy("series")) == F.col("snap"))
        .select("series", "snap", "next", "first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    )
    salted = rows.withColumn("salt", F.pmod(F.hash("rec"), F.lit(SALTS)))
    signed = salted.join(steps, ["series", "snap", "salt"]).select(
        "series", "rec", *[f"v_{n}" for n in fields],
        F.explode(F.array(
            F.struct(F.when(~F.col("first"), F.col("snap")).alias("at"), F.lit(1).alias("sign")),
            F.struct(F.col("next").alias("at"), F.lit(-1).alias("sign")),
        )).alias("s"),
    ).where("s.at is not null")
    names = list(fields)
    presence = F.struct(F.lit(-1).alias("field"), F.lit(None).cast("string").alias("value"))
    cell = lambda k, n: F.struct(F.lit(k).alias("field"), _written(F.col(f"v_{n}"), raw.schema[f"v_{n}"].dataType).alias("value"))
    together = signed.select("series", F.col("s.at").alias("snap"), "rec", F.col("s.sign").alias("sign"), *[f"v_{n}" for n in names]).repartition("series", "snap", "rec")
    cells = together.select("series", "snap", "rec", "sign", F.explode(F.array(presence, *[cell(k, n) for k, n in enumerate(names)])).alias("c"))
    summed = cells.groupBy("series", "snap", "rec", "c.field", "c.value").agg(F.sum("sign").alias("n")).where("n <> 0")
    grouped = summed.groupBy("series", "snap", "rec").agg(
        F.coalesce(F.max(F.when(F.col("field") < 0, F.col("n"))), F.lit(0)).alias("presence"),
        F.array_sort(F.collect_set(F.when(F.col("field") >= 0, F.col("field")))).alias("differing"),
    )
    differing = F.transform("differing", lambda k: F.array(*[F.lit(n) for n in names])[k])
    return (
        grouped.withColumn("changed_fields", differing)
        .withColumn(
            "change_type",
            F.when(F.col("presence") > 0, "added")
            .when(F.col("presence") < 0, "removed")
            .when(F.size("changed_fields") > 0, "changed"),
        )
        .where("change_type is not null")
        .select(
            F.col("series").alias(series), F.col("snap").alias(snapshot), F.col("rec").alias(key),
            "change_type", "changed_fields",
        )
    )
