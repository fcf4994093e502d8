"""Reads over the star.  Facts are counted by key before they meet a dimension, so a company,
a skill or a month that holds a third of the facts is one row by the time of the join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Star = dict[str, DataFrame]


def _count(name: str) -> Column:
    return F.count(F.lit(1)).alias(name)


def postings_per_month(star: Star) -> DataFrame:
    per_day = star["FACT_JOBS"].groupBy("DATE_KEY").agg(_count("n"))
    return (
        per_day.join(star["DIM_DATE"], "DATE_KEY")
        .groupBy("POSTED_YEAR", "POSTED_MONTH")
        .agg(F.sum("n").alias("postings"))
        .orderBy("POSTED_YEAR", "POSTED_MONTH")
    )


def top_companies(star: Star, top: int = 20) -> DataFrame:
    per_key = star["FACT_JOBS"].where("COMPANY_KEY IS NOT NULL").groupBy("COMPANY_KEY").agg(
        _count("postings")
    )
    return (
        per_key.join(star["DIM_COMPANY"], "COMPANY_KEY")
        .select("COMPANY_NAME", "postings")
        .orderBy(F.desc("postings"), "COMPANY_NAME")
        .limit(top)
    )


def postings_per_city(star: Star) -> DataFrame:
    per_key = (
        star["FACT_JOBS"]
        .where("LOCATION_KEY IS NOT NULL")
        .groupBy("LOCATION_KEY")
        .agg(_count("n"), F.count_if("IS_REMOTE").alias("remote"))
    )
    return (
        per_key.join(star["DIM_LOCATION"], "LOCATION_KEY")
        .groupBy("CITY")
        .agg(F.sum("n").alias("postings"), F.sum("remote").alias("remote_postings"))
        .withColumn(
            "remote_share", F.round(F.col("remote_postings") / F.col("postings"), 6)
        )
        .orderBy(F.desc("postings"), "CITY")
    )


def top_skills(star: Star, top: int = 20) -> DataFrame:
    per_key = star["BRIDGE_JOB_SKILL"].groupBy("SKILL_KEY").agg(_count("postings"))
    return (
        per_key.join(star["DIM_SKILL"], "SKILL_KEY")
        .select("SKILL_NAME", "postings")
        .orderBy(F.desc("postings"), "SKILL_NAME")
        .limit(top)
    )


def levels_by_employment(star: Star) -> DataFrame:
    described = star["DIM_JOB"].select("JOB_KEY", "EXPERIENCE_LEVEL", "EMPLOYMENT_TYPE")
    return (
        star["FACT_JOBS"]
        .select("JOB_KEY")
        .join(described, "JOB_KEY")
        .groupBy("EXPERIENCE_LEVEL", "EMPLOYMENT_TYPE")
        .agg(_count("postings"))
        .orderBy("EXPERIENCE_LEVEL", "EMPLOYMENT_TYPE")
    )
