"""Staging: cleaned reports, adversaries and entities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reportstar.functions import (
    blank_to_null,
    clean_text,
    first_non_blank,
    group_key,
    labels,
    member_set,
    parse_date,
    parse_timestamp,
    target_country_key,
    tokens,
)
from reportstar.functions.sets import COMMA, PIPE
from reportstar.plans.texts import apart, held

REPORT_TYPE = "threat"

REPORT_DATES = ("creation_date", "publication_date", "report_date")
# Raw column -> staged label.
REPORT_TEXTS = {
    "classification": "classification_name",
    "evidence_type": "evidence_type_name",
    "importance": "importance_level",
    "observation_source": "source_name",
    "threat_type": "threat_type_name",
}
ENTITY_ATTRIBUTES = (
    "name_en", "name_native", "alt_id", "country", "category", "sector", "entity_type", "domain",
)


def of_type(raw_report: DataFrame, report_type: str) -> DataFrame:
    return raw_report.filter(F.col("report_type") == report_type)


def _merged_list(raw_adversary: DataFrame, column: str) -> DataFrame:
    """(adversary_id, list_text, members) of ids that have one. An id with one text keeps it as it is; of several, the
    members are put together, each once. Members are made distinct before an id's are gathered, so the rows of a hot id
    meet in no task."""
    known = raw_adversary.filter(F.col("adversary_id").isNotNull())
    texts = known.groupBy("adversary_id").agg(F.min(column).alias("least"), F.max(column).alias("most"))
    sets = (
        known.select("adversary_id", F.explode(tokens(F.col(column), PIPE)).alias("member"))
        .distinct()
        .groupBy("adversary_id")
        .agg(F.sort_array(F.collect_list("member")).alias("together"))
    )
    together = F.coalesce("together", F.array().cast("array<string>"))
    several = F.col("least") != F.col("most")
    return texts.join(sets, "adversary_id", "left").select(
        "adversary_id",
        F.when(several, F.array_join(together, "|")).otherwise(F.col("least")).alias("list_text"),
        F.when(several, together).otherwise(tokens(F.col("least"), PIPE)).alias("members"),
    )


def adversary_targets(raw_adversary: DataFrame) -> DataFrame:
    """One row per adversary id: the smallest name, its target countries and their key. Rows without an id are left alone.
    The report lists are not in it, see `link_adversaries`."""
    named = (
        raw_adversary.filter(F.col("adversary_id").isNotNull())
        .groupBy("adversary_id")
        .agg(F.min("adversary").alias("adversary"))
    )
    merged = named.join(_merged_list(raw_adversary, "targeted_country"), "adversary_id").select(
        "adversary_id", "adversary", "list_text", "members"
    )
    unnamed = raw_adversary.filter(F.col("adversary_id").isNull()).select(
        "adversary_id",
        "adversary",
        F.col("targeted_country").alias("list_text"),
        tokens(F.col("targeted_country"), PIPE).alias("members"),
    )
    return merged.unionByName(unnamed).select(
        "adversary_id",
        "adversary",
        F.col("members").alias("country_members"),
        target_country_key(F.col("list_text"), F.col("members")).alias("country_group_key"),
    )


def stage_adversaries(raw_adversary: DataFrame) -> DataFrame:
    """The staged adversary as one table, with the list of its reports as one value. The build does not store the lists,
    nothing reads them: it links the raw lists' members."""
    rest = adversary_targets(raw_adversary)
    lists = _merged_list(raw_adversary, "report_ids").select(
        "adversary_id", F.col("members").alias("member_reports")
    )
    named = rest.filter(F.col("adversary_id").isNotNull()).join(lists, "adversary_id")
    unnamed = raw_adversary.filter(F.col("adversary_id").isNull())
    countries = tokens(F.col("targeted_country"), PIPE)
    columns = ["adversary_id", "adversary", "member_reports", "country_members", "country_group_key"]
    return named.select(columns).unionByName(
        unnamed.select(
            "adversary_id",
            "adversary",
            tokens(F.col("report_ids"), PIPE).alias("member_reports"),
            countries.alias("country_members"),
            target_country_key(F.col("targeted_country"), countries).alias("country_group_key"),
        )
    )


def link_adversaries(raw_adversary: DataFrame) -> DataFrame:
    """(report_id, adversary_ids): the report lists of all adversaries, turned around.

    Exploding the raw lists gives an equi-join key; work grows with the number of links and not with reports x
    adversaries. The set is built map-side first, and rows are dealt by report: an adversary with a third of the feed
    is spread like any other.
    """
    return (
        raw_adversary.filter(F.col("adversary_id").isNotNull())
        .select(F.explode(tokens(F.col("report_ids"), PIPE)).alias("report_id"), "adversary_id")
        .groupBy("report_id")
        .agg(F.collect_set("adversary_id").alias("adversary_ids"))
    )


def stage_report_fields(raw_report: DataFrame, report_type: str = REPORT_TYPE) -> DataFrame:
    """All that a report says itself. One pass over the feed, without a shuffle."""
    reports = of_type(raw_report, report_type)
    entity_source = first_non_blank(F.col("entity_ids"), F.col("entity_names"))
    # In two steps, so that each list is split once although its set looks at it twice.
    split = reports.select(
        F.col("id").alias("report_id"),
        "title",
        *held(raw_report),
        *(parse_date(F.col(c)).alias(c) for c in REPORT_DATES),
        parse_timestamp(F.col("updated_at")).alias("updated_at"),
        *(clean_text(F.col(raw)).alias(label) for raw, label in REPORT_TEXTS.items()),
        tokens(F.col("country"), COMMA).alias("country_members"),
        tokens(entity_source, PIPE).alias("entity_members"),
        tokens(F.col("related_groups"), PIPE).alias("group_members"),
        labels(F.col("country"), COMMA).alias("country_labels"),
    )
    sets = ("country", "entity", "group")
    return split.withColumns(
        {f"{s}_members": member_set(F.col(f"{s}_members")) for s in sets}
    ).withColumns({f"{s}_group_key": group_key(F.col(f"{s}_members")) for s in sets})


# Sets that no member can break, as it holds no separator: column -> (pattern, text) of the separator.
DELIMITED = {
    "country_members": (COMMA, ","),
    "entity_members": (PIPE, "|"),
    "group_members": (PIPE, "|"),
    "country_labels": (COMMA, ","),
}
KEYED_SETS = ("country", "entity", "group", "adversary")


def packed_sets(staged: DataFrame) -> DataFrame:
    """Staged reports for a shuffle: lists as delimited text, without the keys of sets, which follow from these."""
    keys = (f"{s}_group_key" for s in KEYED_SETS)
    return staged.drop(*keys).withColumns({c: F.array_join(c, text) for c, (_, text) in DELIMITED.items()})


def unpacked_sets(packed: DataFrame) -> DataFrame:
    """The lists again, and the keys of the sets; the adversaries, which may hold any separator, travel as a list."""
    lists = packed.withColumns(
        {c: F.array_remove(F.split(c, pattern), "") for c, (pattern, _) in DELIMITED.items()}
    )
    return lists.withColumns({f"{s}_group_key": group_key(F.col(f"{s}_members")) for s in KEYED_SETS})


# Stored table -> its sets, whose keys are not stored: they are hashes, the larger half of the table, and follow from the sets.
UNKEYED_SETS = {"stg_report": ("country", "entity", "group"), "stg_report_adversary": ("adversary",)}


def without_set_keys(name: str, table: DataFrame) -> DataFrame:
    return table.drop(*(f"{s}_group_key" for s in UNKEYED_SETS.get(name, ())))


def with_set_keys(name: str, stored: DataFrame) -> DataFrame:
    """The table as its readers know it, its keys made as they are read."""
    keys = {f"{s}_group_key": group_key(F.col(f"{s}_members")) for s in UNKEYED_SETS.get(name, ())}
    missing = {key: made for key, made in keys.items() if key not in stored.columns}
    last = [c for c in stored.columns if c == "row_key" and name == "stg_report"]
    shown = [c for c in stored.columns if c not in last]
    return stored.withColumns(missing).select(*shown, *missing, *last) if missing else stored


def stage_report_keys(raw_report: DataFrame, report_type: str = REPORT_TYPE) -> DataFrame:
    """The same with a key in place of the texts."""
    return stage_report_fields(apart(raw_report), report_type)


def with_adversaries(reports: DataFrame, adversary_links: DataFrame) -> DataFrame:
    """Add the set of adversaries that claim the report, and its key.

    Adversaries list report ids in upper case while a report keeps its own spelling, so a
    report with a lower-case id is never linked.
    """
    return (
        reports.join(adversary_links, "report_id", "left")
        .withColumn("adversary_members", member_set(F.col("adversary_ids")))
        .withColumn("adversary_group_key", group_key(F.col("adversary_members")))
        .drop("adversary_ids")
    )


def stage_reports(
    raw_report: DataFrame, adversary_links: DataFrame, report_type: str = REPORT_TYPE
) -> DataFrame:
    """The staged report as one table. The build keeps its two halves apart, see
    `build_star`, since joining them moves all texts through a shuffle."""
    return with_adversaries(stage_report_fields(raw_report, report_type), adversary_links)


def registered_entities(raw_entity: DataFrame) -> DataFrame:
    """One row per trimmed registry id: the smallest English name (NULL first), the other
    columns break ties. min() combines before the shuffle, a window would not."""
    cleaned = raw_entity.filter(F.col("registry_id").isNotNull()).select(
        F.trim("registry_id").alias("registry_id"),
        F.struct(*(clean_text(F.col(c)).alias(c) for c in ENTITY_ATTRIBUTES)).alias("entity"),
    )
    return (
        cleaned.groupBy("registry_id")
        .agg(F.min("entity").alias("entity"))
        .select("registry_id", "entity.*", F.lit(True).alias("is_registered"))
    )


def report_entity_labels(raw_report: DataFrame, report_type: str = REPORT_TYPE) -> DataFrame:
    """Distinct names from reports whose id list is NULL; a blank id list does not count."""
    names = of_type(raw_report, report_type).filter(F.col("entity_ids").isNull())
    return (
        names.select(F.explode(F.split("entity_names", PIPE)).alias("name"))
        .select(F.trim("name").alias("name_native"))
        .filter(F.col("name_native") != "")
        .distinct()
    )


def unregistered_labels(report_labels: DataFrame, registered: DataFrame) -> DataFrame:
    known = registered.select(F.upper("name_native").alias("known_name")).distinct()
    return report_labels.join(known, F.upper("name_native") == F.col("known_name"), "left_anti")


def stage_entities(
    raw_entity: DataFrame, raw_report: DataFrame, report_type: str = REPORT_TYPE
) -> DataFrame:
    """Registered entities and names known from reports only, one row per natural key:
    a registered row goes first, then the smallest name."""
    registered = registered_entities(raw_entity)
    label_only = unregistered_labels(report_entity_labels(raw_report, report_type), registered)
    everything = registered.unionByName(
        label_only.select(
            "name_native", F.col("name_native").alias("name_en"), F.lit(False).alias("is_registered")
        ),
        allowMissingColumns=True,
    )
    columns = ["registry_id", *ENTITY_ATTRIBUTES, "is_registered"]
    ranked = everything.select(
        F.upper(F.coalesce("registry_id", "name_native")).alias("entity_natural_key"),
        F.struct(
            (~F.col("is_registered")).alias("label_only"),
            *ENTITY_ATTRIBUTES,
            "registry_id",
            "is_registered",
        ).alias("entity"),
    )
    return (
        ranked.groupBy("entity_natural_key")
        .agg(F.min("entity").alias("entity"))
        .select("entity_natural_key", *(F.col(f"entity.{c}").alias(c) for c in columns))
    )
