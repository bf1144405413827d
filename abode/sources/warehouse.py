"""Warehouse attribute observations in one scan of the fact table.

The fact table holds one code column per attribute. Homes meet the address
cross-reference and their own dated details on the home id, so one
partitioning serves both joins; only then are the code columns unpivoted, and
the code dictionary names the codes. Details of a home are gathered as a map
from code to dates, bounded by what one home has. Result rows have the
observation shape ``(UPRN, TIMESTAMP, attr, value, SOURCE, seq)``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from abode.functions.dates import cap_year
from abode.rules import e1


def warehouse_observations(
    homes: DataFrame,
    dictionary: DataFrame,
    details: DataFrame,
    xref: DataFrame,
    attributes: Sequence[tuple[str, str, str]],
    region: Sequence[str],
    constant_date: str = "2000-12-31",
    cap_after_year: int = 2015,
    cap_date: str = "2000-01-01",
    source: str = e1.SOURCE_WAREHOUSE,
    home_id: str = "HOME_ID",
    region_col: str = "GOV_REG_CODE",
    dict_code: str = "DETAIL_LOOKUP_CODE",
    dict_name: str = "DETAIL_LOOKUP_NAME",
    detail_home: str = "HOMES_HOME_ID",
    detail_code: str = "DETS_LKP_DET_LKP_ID",
    detail_date: str = "DETAIL_DATE",
    xref_key: str = "UPRN",
    xref_home: str = e1.XREF_HOME_COLUMN,
) -> DataFrame:
    """``attributes`` = [(attr name, code column, "constant" | "capped"), ...]."""
    dated = [c for _, c, rule in attributes if rule == "capped"]
    kept = homes.where(F.col(region_col).isin(list(region))).select(
        F.col(home_id).alias("home"), *[F.col(c).cast("string").alias(c) for _, c, _ in attributes])
    keys = xref.select(F.col(xref_home).alias("home"), F.col(xref_key).alias("UPRN"))
    placed = kept.join(keys, "home")
    if dated:
        found = details.select(F.col(detail_home).alias("home"), F.col(detail_code).cast("string").alias("code"),
                               F.col(detail_date).cast("date").alias("d"))
        per_home = found.where("home IS NOT NULL AND code IS NOT NULL").groupBy("home").agg(
            F.collect_list(F.struct("code", "d")).alias("details"))
        placed = placed.join(per_home, "home", "left")

    def observed(attr: str, code: str, rule: str) -> Column:
        """Observations of one attribute: dated ones need a detail row of their
        code, one observation each; undated ones take the constant date."""
        def one(ts: Column) -> Column:
            return F.struct(F.lit(attr).alias("attr"), F.col(code).alias("code"), ts.alias("TIMESTAMP"))

        if rule != "capped":
            return F.array(one(F.lit(constant_date).cast("date")))
        mine = F.filter(F.coalesce("details", F.array().cast("array<struct<code:string,d:date>>")), lambda d: d["code"] == F.col(code))
        return F.transform(mine, lambda d: one(cap_year(d["d"], cap_after_year, cap_date)))

    every = F.concat(*[observed(*a) for a in attributes])
    codes = placed.select("home", "UPRN", F.explode(F.filter(every, lambda o: o["code"].isNotNull())).alias("o")).select("home", "UPRN", "o.*")
    names = dictionary.select(F.col(dict_code).cast("string").alias("code"), F.col(dict_name).alias("value"))
    return codes.join(names, "code").select(
        "UPRN", "TIMESTAMP", "attr", "value", F.lit(source).alias("SOURCE"), F.col("home").cast("long").alias("seq"))
