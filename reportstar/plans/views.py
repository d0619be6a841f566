"""The views analysts read. Each takes the stored star and is lazy.

Bridge and dimension are joined first, at the size of the distinct sets; the reports meet
the result once, on the group key.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reportstar.operators.bridging import UNKNOWN_ID
from reportstar.operators.counting import summarize_reports_by
from reportstar.plans.dims import LABEL_COLUMNS
from reportstar.functions.sets import key_bytes
from reportstar.plans.fact import GROUP_KEYS, beside_texts
from reportstar.plans.keys import REPORT_LABELS
from reportstar.plans.pipeline import LABEL_DIM_TABLES, Star
from reportstar.plans.texts import TEXT_KEY, TEXTS
from reportstar.sinks.store import CatalogStore, replace_view

# Dimension -> column name in the report view.
REPORT_VIEW_LABELS = {
    "classification": "classification",
    "evidence_type": "evidence_type",
    "importance_level": "importance",
    "source": "observation_source",
    "threat_type": "threat_type",
}
HEADER = ("report_id", "title", "report_date", "classification", "importance", "threat_type")
SHARE = ("weight_factor", "is_unknown_member")


def _labelled(star: Star, view: DataFrame) -> DataFrame:
    for dimension in REPORT_LABELS:
        dim = star[LABEL_DIM_TABLES[dimension]].select(
            F.col("id").alias(f"{dimension}_id"),
            F.col(LABEL_COLUMNS[dimension]).alias(REPORT_VIEW_LABELS[dimension]),
        )
        view = view.join(dim, f"{dimension}_id")
    return view


def vw_report(star: Star) -> DataFrame:
    """Texts stored apart meet narrow rows: labels and the text of keys come afterwards."""
    stored = star.fact_keyed
    view = star["fact_report"] if stored is None else beside_texts(stored, star["report_text"])
    return _labelled(star, view).select(
        "id",
        "report_id",
        "title",
        "description",
        "actions",
        "analysis",
        "creation_date",
        "publication_date",
        "report_date",
        F.col("report_updated_at").alias("updated_at"),
        *REPORT_VIEW_LABELS.values(),
        *GROUP_KEYS,
    )


def country_members(star: Star) -> DataFrame:
    dim = star["dim_country"].select(F.col("id").alias("country_id"), "country_name")
    return (
        star["bridge_country"]
        .join(dim, "country_id")
        .select("country_group_key", "country_id", "country_name", *SHARE)
    )


def entity_members(star: Star) -> DataFrame:
    dim = star["dim_entity"].select(
        F.col("id").alias("entity_id"),
        "name_en",
        "name_native",
        "registry_id",
        "alt_id",
        "sector",
        "category",
        "entity_type",
        F.col("country").alias("entity_country"),
        "is_registered",
    )
    return (
        star["bridge_entity"]
        .join(dim, "entity_id")
        .select("entity_group_key", *dim.columns, *SHARE)
    )


def group_members(star: Star) -> DataFrame:
    dim = star["dim_adversary"].select(F.col("id").alias("adversary_dim_id"), "adversary_name")
    return (
        star["bridge_group_adversary"]
        .join(dim, "adversary_dim_id")
        .select(
            "group_group_key",
            F.col("member_value").alias("group_label"),
            F.col("adversary_dim_id").alias("adversary_id"),
            "adversary_name",
            *SHARE,
        )
    )


def adversary_members(star: Star) -> DataFrame:
    dim = star["dim_adversary"].select(F.col("id").alias("adversary_dim_id"), "adversary_name")
    return (
        star["bridge_adversary"]
        .join(dim, "adversary_dim_id")
        .select(
            "adversary_group_key",
            F.col("adversary_dim_id").alias("adversary_id"),
            "adversary_name",
            *SHARE,
        )
    )


def _member_view(star: Star, members: DataFrame, key: str) -> DataFrame:
    reports = _labelled(star, star.reports).select(*HEADER, key_bytes(F.col(key)).alias(key))
    return reports.join(members.withColumn(key, key_bytes(F.col(key))), key).drop(key)


def vw_report_country(star: Star) -> DataFrame:
    return _member_view(star, country_members(star), "country_group_key")


def vw_report_entity(star: Star) -> DataFrame:
    return _member_view(star, entity_members(star), "entity_group_key")


def vw_report_group(star: Star) -> DataFrame:
    return _member_view(star, group_members(star), "group_group_key")


def vw_report_adversary(star: Star) -> DataFrame:
    return _member_view(star, adversary_members(star), "adversary_group_key")


def adversary_targets(star: Star) -> DataFrame:
    """Known target countries of known adversaries, unordered."""
    adversary = (
        star["dim_adversary"]
        .filter(F.col("id") != UNKNOWN_ID)
        .select("adversary_id", "adversary_name", "country_group_key")
    )
    bridge = star["bridge_adversary_country"].filter(
        ~F.col("is_unknown_member") & (F.col("country_id") != UNKNOWN_ID)
    )
    country = star["dim_country"].select(F.col("id").alias("country_id"), "country_name")
    per_adversary = Window.partitionBy("adversary_id", "country_group_key")
    return (
        adversary.join(bridge, ["country_group_key", "adversary_id"])
        .join(country, "country_id")
        .select(
            "adversary_id",
            "adversary_name",
            "country_group_key",
            "country_id",
            "country_name",
            *SHARE,
            F.count("*").over(per_adversary).alias("total_targeted_countries"),
        )
    )


def vw_adversary_target_country(star: Star) -> DataFrame:
    return adversary_targets(star).orderBy("adversary_name", "country_name")


def metric_rows(metrics: DataFrame) -> DataFrame:
    """One row of named counts as (metric, value) rows."""
    names = metrics.columns
    return metrics.unpivot([], names, "metric", "value")


def vw_entity_coverage(star: Star) -> DataFrame:
    """Five counts. The last one is of reports with any unknown entity; the one before it
    counts sets."""
    known = F.col("id") != UNKNOWN_ID
    registered = F.col("is_registered")
    entities = star["dim_entity"].agg(
        F.count_if(known & registered).alias("registered_entities"),
        F.count_if(known & registered & F.col("alt_id").isNotNull()).alias(
            "registered_entities_with_alt_id"
        ),
        F.count_if(known & ~registered).alias("label_only_entities"),
    )
    sets = star["bridge_entity"].agg(
        F.count_if("is_unknown_member").alias("unresolved_report_members")
    )
    unknown_sets = star["bridge_entity"].filter("is_unknown_member")
    reports = summarize_reports_by(
        star.reports,
        "entity_group_key",
        unknown_sets,
        ["is_unknown_member"],
        star.unique_report_ids,
    ).agg(F.coalesce(F.sum("reports"), F.lit(0)).alias("reports_with_no_known_entity"))
    return (
        metric_rows(entities).unionByName(metric_rows(sets)).unionByName(metric_rows(reports))
    )


VIEWS = {
    "vw_report": vw_report,
    "vw_report_country": vw_report_country,
    "vw_report_entity": vw_report_entity,
    "vw_report_group": vw_report_group,
    "vw_report_adversary": vw_report_adversary,
    "vw_adversary_target_country": vw_adversary_target_country,
    "vw_entity_coverage": vw_entity_coverage,
}


REPORT_SHOWN = ", ".join(HEADER)


def view_sql(table: Callable[[str], str]) -> dict[str, str]:
    """SQL of the seven views over stored tables, for a catalog; `table` spells a table's name."""

    def members(bridge: str, key: str, dim: str, fk: str, shown: str) -> str:
        return (
            f"SELECT {REPORT_SHOWN}, {shown}, weight_factor, is_unknown_member "
            f"FROM {table('vw_report')} INNER JOIN {table(bridge)} USING ({key}) "
            f"INNER JOIN {table(dim)} AS m ON m.id = {fk}"
        )

    fact = "id, report_id, title, description, actions, analysis, creation_date, publication_date, report_date"
    labels = " ".join(
        f"INNER JOIN (SELECT id AS {d}_id, {LABEL_COLUMNS[d]} AS {shown} "
        f"FROM {table(LABEL_DIM_TABLES[d])}) USING ({d}_id)"
        for d, shown in REPORT_VIEW_LABELS.items()
    )
    # Grouped, as in texts.with_texts: a view that shows no text then reads none.
    texts = (
        f"LEFT JOIN (SELECT {TEXT_KEY}, {', '.join(f'first({c}) AS {c}' for c in TEXTS)} "
        f"FROM {table('report_text')} GROUP BY {TEXT_KEY}) USING ({TEXT_KEY})"
    )
    known = f"FROM {table('dim_entity')} WHERE id <> {UNKNOWN_ID}"
    return {
        "vw_report": f"SELECT {fact}, report_updated_at AS updated_at, "
        + ", ".join(REPORT_VIEW_LABELS.values())
        + f", {', '.join(GROUP_KEYS)} FROM {table('fact_report')} {labels} {texts}",
        "vw_report_country": members(
            "bridge_country", "country_group_key", "dim_country", "country_id", "country_id, country_name"
        ),
        "vw_report_entity": members(
            "bridge_entity", "entity_group_key", "dim_entity", "entity_id",
            "entity_id, name_en, name_native, registry_id, alt_id, sector, category, entity_type, "
            "m.country AS entity_country, is_registered",
        ),
        "vw_report_group": members(
            "bridge_group_adversary", "group_group_key", "dim_adversary", "adversary_dim_id",
            "member_value AS group_label, m.id AS adversary_id, adversary_name",
        ),
        "vw_report_adversary": members(
            "bridge_adversary", "adversary_group_key", "dim_adversary", "adversary_dim_id",
            "m.id AS adversary_id, adversary_name",
        ),
        "vw_adversary_target_country": f"""
            SELECT adversary_id, adversary_name, country_group_key, country_id, country_name, weight_factor,
                   is_unknown_member,
                   count(*) OVER (PARTITION BY adversary_id, country_group_key) AS total_targeted_countries
            FROM {table('bridge_adversary_country')}
            INNER JOIN (SELECT adversary_id, country_group_key, adversary_name
                        FROM {table('dim_adversary')} WHERE id <> {UNKNOWN_ID})
              USING (adversary_id, country_group_key)
            INNER JOIN (SELECT id AS country_id, country_name FROM {table('dim_country')}) USING (country_id)
            WHERE country_id <> {UNKNOWN_ID} AND NOT is_unknown_member""",
        "vw_entity_coverage": f"""
            SELECT stack(3, 'registered_entities', count_if(is_registered),
                         'registered_entities_with_alt_id', count_if(is_registered AND alt_id IS NOT NULL),
                         'label_only_entities', count_if(NOT is_registered)) AS (metric, value) {known}
            UNION ALL SELECT 'unresolved_report_members', count_if(is_unknown_member)
            FROM {table('bridge_entity')}
            UNION ALL SELECT 'reports_with_no_known_entity', count(DISTINCT report_id)
            FROM {table('fact_report')} LEFT SEMI JOIN
              (SELECT entity_group_key FROM {table('bridge_entity')} WHERE is_unknown_member)
              USING (entity_group_key)""",
    }


def create_catalog_views(store: CatalogStore) -> None:
    """The seven views in the catalog of `store`, over its tables."""
    for name, sql in view_sql(store.table).items():
        store.create_view(name, sql)


def create_views(star: Star) -> None:
    """Session views over the stored tables, so that SQL users find them by name."""
    for name, view in VIEWS.items():
        replace_view(view(star), name)
