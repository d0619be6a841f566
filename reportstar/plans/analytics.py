"""Business questions over the views.

The questions are asked of fact, bridges and dimensions directly: sums per group key or per
dimension id come first, names are attached to the few rows that are left.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reportstar.functions.sets import key_bytes
from reportstar.operators.counting import rows_per_set, split_ids, summarize_reports_by
from reportstar.plans.pipeline import Star
from reportstar.plans.views import adversary_targets, country_members, entity_members

# Importance is text; an average needs an order. Other values are not rated.
SEVERITY = {"low": 1, "medium": 2, "high": 3, "critical": 4}

KNOWN = "NOT is_unknown_member"


def _severity_of(label: Column, scale: Mapping[str, int]) -> Column:
    levels = F.create_map(*(F.lit(x) for pair in scale.items() for x in pair))
    return F.try_element_at(levels, F.lower(label)).cast("long")


def rated_reports(star: Star, scale: Mapping[str, int] = SEVERITY) -> DataFrame:
    """The fact with `severity` (NULL if not rated) and `rated` (0 or 1)."""
    severity = star["dim_importance_level"].select(
        F.col("id").alias("importance_level_id"),
        _severity_of(F.col("importance_level"), scale).alias("severity"),
    )
    return (
        star.reports
        .join(severity, "importance_level_id")
        .withColumn("rated", F.col("severity").isNotNull().cast("long"))
    )


def _average_severity() -> Column:
    return F.round(F.try_divide(F.col("severity"), F.col("rated")), 6).alias("avg_severity")


def _share() -> Column:
    return F.round("share", 6).alias("weighted_reports")


def adversary_country(star: Star) -> DataFrame:
    return (
        adversary_targets(star)
        .groupBy("adversary_name", "country_name")
        .agg(F.count("*").alias("incident_count"))
        .orderBy(F.desc("incident_count"))
    )


def adversary_country_reports(star: Star, scale: Mapping[str, int] = SEVERITY) -> DataFrame:
    """Reports attributed to an adversary, next to each country it is known to target."""
    per_set = rows_per_set(
        rated_reports(star, scale), ["adversary_group_key"], ["severity", "rated"]
    )
    per_adversary = (
        star["bridge_adversary"]
        .filter(KNOWN)
        .join(per_set, "adversary_group_key")
        .groupBy("adversary_dim_id")
        .agg(*(F.sum(c).alias(c) for c in ("reports", "severity", "rated")))
    )
    dim = star["dim_adversary"].select(F.col("id").alias("adversary_dim_id"), "adversary_id")
    return (
        adversary_targets(star)
        .join(per_adversary.join(dim, "adversary_dim_id"), "adversary_id")
        .groupBy("adversary_name", "country_name")
        .agg(*(F.sum(c).alias(c) for c in ("reports", "severity", "rated")))
        .select(
            "adversary_name",
            "country_name",
            F.col("reports").alias("report_count"),
            _average_severity(),
        )
        .orderBy(F.desc("report_count"))
    )


def top_entities(star: Star) -> DataFrame:
    return (
        summarize_reports_by(
            star.reports,
            "entity_group_key",
            entity_members(star).filter(KNOWN),
            ["name_en", "sector"],
            star.unique_report_ids,
        )
        .select("name_en", "sector", F.col("reports").alias("attacks"))
        .orderBy(F.desc("attacks"))
    )


def top_entities_severity(star: Star, scale: Mapping[str, int] = SEVERITY) -> DataFrame:
    by = ["name_en", "sector", "entity_country"]
    return (
        summarize_reports_by(
            rated_reports(star, scale),
            "entity_group_key",
            entity_members(star).filter(KNOWN),
            by,
            star.unique_report_ids,
            ["severity", "rated"],
        )
        .select(*by, F.col("reports").alias("incident_count"), _average_severity())
        .orderBy(F.desc("incident_count"))
    )


def country_distribution(star: Star, scale: Mapping[str, int] = SEVERITY) -> DataFrame:
    """Known countries: distinct reports, distinct known adversaries attributed to them,
    average severity. Countries meet adversaries over distinct pairs of sets."""
    countries = country_members(star).filter(KNOWN)
    reports = summarize_reports_by(
        rated_reports(star, scale),
        "country_group_key",
        countries,
        ["country_name"],
        star.unique_report_ids,
        ["severity", "rated"],
    )
    links = star["bridge_adversary"].filter(KNOWN).select("adversary_group_key", "adversary_dim_id")
    pairs = (
        star.reports.select("country_group_key", "adversary_group_key").distinct()
        .join(countries.select("country_group_key", "country_name"), "country_group_key")
        .select("country_name", "adversary_group_key")
        .distinct()
        .join(links, "adversary_group_key")
        .select("country_name", "adversary_dim_id")
    )
    _, several = ids_apart(star, ["country_group_key", "adversary_group_key"])
    if several is not None:
        # Reports of one id are one report: each country of the id meets each of its adversaries.
        of_id = lambda key, members: (
            several.join(members, key).select("report_id", members.columns[-1]).distinct()
        )
        named = of_id("country_group_key", countries.select("country_group_key", "country_name"))
        pairs = pairs.unionByName(
            named.join(of_id("adversary_group_key", links), "report_id").drop("report_id").distinct()
        )
    adversaries = pairs.groupBy("country_name").agg(
        F.countDistinct("adversary_dim_id").alias("unique_adversaries")
    )
    return (
        reports.join(adversaries, "country_name", "left")
        .select(
            "country_name",
            F.col("reports").alias("report_count"),
            F.coalesce("unique_adversaries", F.lit(0)).alias("unique_adversaries"),
            _average_severity(),
        )
        .orderBy(F.desc("report_count"))
    )


def country_severity(star: Star, scale: Mapping[str, int] = SEVERITY) -> DataFrame:
    """Rows of the country view and their average severity, the unknown country included."""
    return (
        summarize_reports_by(
            rated_reports(star, scale),
            "country_group_key",
            country_members(star),
            ["country_name"],
            star.unique_report_ids,
            ["severity", "rated"],
        )
        .select("country_name", F.col("member_rows").alias("reports"), _average_severity())
        .orderBy(F.desc("reports"))
    )


def monthly_trend(star: Star, scale: Mapping[str, int] = SEVERITY) -> DataFrame:
    threat = star["dim_threat_type"].select(
        F.col("id").alias("threat_type_id"), F.col("threat_type_name").alias("threat_type")
    )
    counts = rows_per_set(
        rated_reports(star, scale).withColumn("month", F.trunc("report_date", "month")),
        ["month", "threat_type_id"],
        ["severity", "rated"],
    )
    return (
        counts.join(threat, "threat_type_id")
        .select("month", "threat_type", F.col("reports").alias("incidents"), _average_severity())
        .orderBy(F.desc("month"), F.desc("incidents"))
    )


def weighted_country(star: Star) -> DataFrame:
    """Fair-share reports per country: a report on n countries counts 1/n for each."""
    return (
        summarize_reports_by(
            star.reports,
            "country_group_key",
            country_members(star),
            ["country_name"],
            star.unique_report_ids,
        )
        .select("country_name", F.col("reports").alias("report_count"), _share())
        .orderBy(F.desc("weighted_reports"))
    )


def sector_breakdown(star: Star) -> DataFrame:
    by = ["sector", "category", "entity_type"]
    return summarize_reports_by(
        star.reports,
        "entity_group_key",
        entity_members(star).filter("is_registered"),
        by,
        star.unique_report_ids,
    ).select(*by, F.col("reports").alias("report_count"), _share())


SET_PAIR = ["group_group_key", "adversary_group_key"]


def ids_apart(star: Star, keys: list[str], reports: DataFrame | None = None) -> tuple[DataFrame, DataFrame | None]:
    """Distinct report ids per combination of `keys`, and (id, keys) of ids that have several. `reports`: the fact, if
    its keys are to be spelled differently."""
    reports = star.reports if reports is None else reports
    if star.unique_report_ids:
        return rows_per_set(reports, keys).withColumnRenamed("reports", "ids"), None
    return split_ids(reports, keys)


def _by_pair(star: Star) -> DataFrame:
    return star.reports.select("report_id", *(key_bytes(F.col(k)).alias(k) for k in SET_PAIR))


def _met(star: Star, reports: DataFrame, by: list[str]) -> DataFrame:
    """(by, known adversary, named, attributed) of each of `reports` (by, pair of sets): the two views in a full outer
    join. The members of a set are one value, so that each pair meets its adversaries inside its row."""

    def members(bridge: str, key: str) -> DataFrame:
        known = star[bridge].filter(KNOWN).select(key_bytes(F.col(key)).alias(key), "adversary_dim_id")
        return known.groupBy(key).agg(F.collect_set("adversary_dim_id").alias(bridge))

    def found(ids: Column, named: bool, attributed: bool) -> Column:
        return F.transform(
            ids,
            lambda i: F.struct(
                i.alias("adversary_id"),
                F.lit(named).alias("named_in_report"),
                F.lit(attributed).alias("attributed"),
            ),
        )

    met = reports.join(members("bridge_group_adversary", "group_group_key"), "group_group_key", "left").join(
        members("bridge_adversary", "adversary_group_key"), "adversary_group_key", "left"
    )
    none = F.array().cast("array<long>")
    named = F.coalesce("bridge_group_adversary", none)
    claimed = F.coalesce("bridge_adversary", none)
    both = F.concat(
        found(F.array_intersect(named, claimed), True, True),
        found(F.array_except(named, claimed), True, False),
        found(F.array_except(claimed, named), False, True),
    )
    return met.select(*by, F.inline(both))


def _agreement(star: Star, reports: DataFrame, by: list[str]) -> DataFrame:
    """The same, summed up over reports that share `by`."""
    return _met(star, reports, by).groupBy(*by, "adversary_id").agg(
        F.max("named_in_report").alias("named_in_report"), F.max("attributed").alias("attributed")
    )


def _with_adversary_name(star: Star, df: DataFrame) -> DataFrame:
    names = star["dim_adversary"].select(F.col("id").alias("adversary_id"), "adversary_name")
    return df.join(names, "adversary_id")


def attribution_agreement(star: Star) -> DataFrame:
    """Per report id and known adversary: named by the report, attributed by the registry. Reports without an id are
    no one's."""
    shown = ["report_id", "adversary_id", "adversary_name", "named_in_report", "attributed"]
    pairs = _by_pair(star)
    alone, several = ids_apart(star, SET_PAIR, pairs)
    by_pair = _with_adversary_name(star, _met(star, alone.select(*SET_PAIR), SET_PAIR))
    reports = pairs.filter(F.col("report_id").isNotNull())
    if several is None:
        if not star.unique_report_ids:
            reports = reports.distinct()
        return reports.join(by_pair, SET_PAIR).select(shown)
    once = reports.distinct().join(several.select("report_id").distinct(), "report_id", "left_anti")
    many = _with_adversary_name(star, _agreement(star, several, ["report_id"]))
    return once.join(by_pair, SET_PAIR).select(shown).unionByName(many.select(shown))


def attribution_summary(star: Star) -> DataFrame:
    """Per known adversary, distinct report ids by who names it."""
    named, attributed = F.col("named_in_report"), F.col("attributed")

    def ids_where(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("ids")).otherwise(0))

    alone, several = ids_apart(star, SET_PAIR, _by_pair(star))
    found = _met(star, alone, ["ids"])
    if several is not None:
        many = _agreement(star, several, ["report_id"]).withColumn("ids", F.lit(1).cast("long"))
        found = found.unionByName(many.select(found.columns))
    totals = found.groupBy("adversary_id").agg(
        ids_where(named & attributed).alias("agreed"),
        ids_where(named & ~attributed).alias("named_only"),
        ids_where(~named & attributed).alias("attributed_only"),
    )
    return _with_adversary_name(star, totals).select(
        "adversary_id", "adversary_name", "agreed", "named_only", "attributed_only"
    )
