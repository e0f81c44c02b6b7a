"""Derived relations of companies: control through chains of holdings, parties that share officers, industries by mapping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graniteflow.session import cut


def indirect_control(holdings: DataFrame, majority: float = 50.0, known: DataFrame | None = None) -> DataFrame:
    """(controller, controlled, steps): who controls whom through chains of holdings above ``majority`` percent.

    ``holdings`` (holder, held, percent) may repeat; the parts of one holder count together. Chains are doubled a round, so
    the rounds grow with the logarithm of the longest one; a pair keeps its fewest steps, which also ends rings. Nobody
    controls themselves; pairs of ``known`` (controller, controlled) are left out.
    """
    total = holdings.where("holder IS NOT NULL AND held IS NOT NULL AND holder <> held").groupBy("holder", "held").agg(F.sum("percent").alias("percent"))
    links = cut(total.where(F.col("percent") > majority).select(F.col("holder").alias("controller"), F.col("held").alias("controlled"), F.lit(1).alias("steps")))
    while True:
        on = links.select(F.col("controller").alias("controlled"), F.col("controlled").alias("far"), F.col("steps").alias("more"))
        longer = links.join(on, "controlled").where("controller <> far").select("controller", F.col("far").alias("controlled"), (F.col("steps") + F.col("more")).alias("steps"))
        new = cut(links.union(longer).groupBy("controller", "controlled").agg(F.min("steps").alias("steps")))
        same = new.join(links, ["controller", "controlled", "steps"], "left_anti").isEmpty()
        links = new
        if same:
            break
    return links if known is None else links.join(known, ["controller", "controlled"], "left_anti")


def shared_officers(officers: DataFrame, most: int = 1000) -> DataFrame:
    """(company_a, company_b, officers): companies that share officers of one name and birth date, a before b, and how many.

    A row of ``officers`` (company, name, born) without a name or birth date meets nobody. An officer of more than ``most``
    companies is met in blocks of them, so no task holds all pairs of a frequent name.
    """
    one = officers.where("name IS NOT NULL AND born IS NOT NULL AND company IS NOT NULL").select("company", "name", "born").distinct()
    size = one.groupBy("name", "born").agg(F.ceil(F.count("*") / most).cast("int").alias("blocks")).where("blocks > 0")
    placed = one.join(size, ["name", "born"]).withColumn("block", F.pmod(F.xxhash64("company"), F.col("blocks")).cast("int"))
    other = placed.select("name", "born", F.col("company").alias("company_b"), F.col("block").alias("other"))
    met = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).join(other, ["name", "born", "other"])
    pairs = met.where("company < company_b").groupBy(F.col("company").alias("company_a"), "company_b").agg(F.count("*").alias("officers"))
    return pairs


def mapped_industries(own: DataFrame, mapping: DataFrame, least: float = 0.8) -> DataFrame:
    """(company, industry, confidence, derived): the industries of companies and those that a mapping adds, by best confidence.

    ``mapping`` (from_industry, to_industry, confidence) counts from ``least`` on; what a company has already is not added.
    """
    good = mapping.where(F.col("confidence") >= least)
    added = own.join(good, F.col("industry") == F.col("from_industry")).groupBy("company", F.col("to_industry").alias("industry")).agg(F.max("confidence").alias("confidence"))
    fresh = added.join(own, ["company", "industry"], "left_anti")
    return own.select("company", "industry").distinct().select("company", "industry", F.lit(1.0).alias("confidence"), F.lit(False).alias("derived")).union(fresh.select("company", "industry", "confidence", F.lit(True)))
