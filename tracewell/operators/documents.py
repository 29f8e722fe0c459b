"""JSON documents as trees: every value by its path, and how two trees differ.

Trees are variants, opened one level at a time by a lateral ``variant_explode``. Each level is a written table, so the
number of jobs is the depth of the deepest document, whatever the number of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewell.session import written_table

ROOT = "$"
PLAIN_KEY = r"^[A-Za-z_][A-Za-z0-9_]*$"


def tree_leaves(documents: DataFrame, key: str, value: str = "v") -> DataFrame:
    """``key, path, value`` of every leaf of a variant column: scalars, nulls, and objects and arrays without members.

    Paths are ``$.a.b[0]``, other names quoted as in ``$['a b']``. ``value`` is the leaf as JSON, so ``1`` and ``"1"`` differ. A null
    variant (no document) has no leaf. ``key`` tells documents apart.
    """
    spark = documents.sparkSession
    level = documents.select(F.col(key).alias("key"), F.lit(ROOT).alias("path"), F.col(value).alias("v")).filter("v is not null")
    found = []
    while True:
        kind = F.schema_of_variant("v")
        known = written_table(
            level.withColumn("kind", F.when(F.startswith(kind, F.lit("OBJECT<")) & (kind != "OBJECT<>"), "object")
                             .when(F.startswith(kind, F.lit("ARRAY<")) & (F.to_json("v") != "[]"), "array").otherwise("leaf")), "tree-level")
        found.append(known.filter("kind = 'leaf'").select("key", "path", F.to_json("v").alias("value")))
        inner = known.filter("kind <> 'leaf'")
        if inner.isEmpty():
            break
        members = inner.alias("t").lateralJoin(
            spark.tvf.variant_explode(F.col("t.v").outer()).select(
                F.col("pos"), F.col("key").alias("member"), F.col("value").alias("inside")))
        step = (
            F.when(F.col("kind") == "array", F.concat(F.lit("["), F.col("pos").cast("string"), F.lit("]")))
            .when(F.col("member").rlike(PLAIN_KEY), F.concat(F.lit("."), "member"))
            .otherwise(F.concat(F.lit("['"), F.col("member"), F.lit("']")))
        )
        level = members.select(F.col("t.key").alias("key"), F.concat("path", step).alias("path"), F.col("inside").alias("v"))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out.withColumnRenamed("key", key) if key != "key" else out


def tree_differences(left: DataFrame, right: DataFrame, key: str, left_name: str = "left", right_name: str = "right") -> DataFrame:
    """Paths at which the variants ``v`` of equal ``key`` differ, with both values as JSON (null where a side has no such
    path) and ``kind``: changed, only_<left_name> or only_<right_name>. Keys of one side only give all their leaves."""
    a = tree_leaves(left, key).withColumnRenamed("value", left_name)
    b = tree_leaves(right, key).withColumnRenamed("value", right_name)
    kind = (
        F.when(F.col(left_name).isNull(), f"only_{right_name}").when(F.col(right_name).isNull(), f"only_{left_name}")
        .otherwise("changed")
    )
    return (
        a.join(b, [key, "path"], "full_outer").filter(~F.col(left_name).eqNullSafe(F.col(right_name)))
        .select(key, "path", left_name, right_name, kind.alias("kind"))
    )
