"""Matching of places to units of an administrative hierarchy by the names of their district and province."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import script


def matched(places: DataFrame, units: DataFrame, base: Callable[[Column], Column]) -> DataFrame:
    """(place_id, province_unit, district_unit, how) of places (place_id, province, district) by units (unit, name, level, parent), levels `province` and `district`.

    Names are compared folded, letters and digits alone. A province is its name's least unit. A district is looked for by its name, then by
    `base` of it: under its province (how `province`, `province-base`), else wherever just one district has the name (`name`, `name-base`).
    """
    name = lambda c: F.nullif(script.alnum(F.col(c)), F.lit(""))
    known = units.select("unit", name("name").alias("n"), "level", "parent").where("n is not null")
    provinces = known.where("level = 'province'")
    first = provinces.groupBy(F.col("n").alias("p")).agg(F.min("unit").alias("province_unit"))
    districts = known.where("level = 'district'")
    under = districts.join(provinces.select(F.col("unit").alias("parent"), F.col("n").alias("p")), "parent").groupBy("p", "n").agg(F.min("unit").alias("unit"))
    alone = districts.groupBy("n").agg(F.count("*").alias("c"), F.min("unit").alias("unit")).where("c = 1").drop("c")
    out = places.select("place_id", name("province").alias("p"), name("district").alias("k0"), F.nullif(script.alnum(base(F.col("district"))), F.lit("")).alias("k1"))
    for k in ("k0", "k1"):
        out = out.join(under.select("p", F.col("n").alias(k), F.col("unit").alias(f"u_{k}")), ["p", k], "left").join(alone.select(F.col("n").alias(k), F.col("unit").alias(f"a_{k}")), k, "left")
    order = [("u_k0", "province"), ("a_k0", "name"), ("u_k1", "province-base"), ("a_k1", "name-base")]
    how = F.coalesce(*(F.when(F.col(c).isNotNull(), F.lit(h)) for c, h in order))
    return out.join(first, "p", "left").select("place_id", "province_unit", F.coalesce(*(c for c, _ in order)).alias("district_unit"), how.alias("how"))
