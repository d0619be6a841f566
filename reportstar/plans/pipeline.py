"""The full build: every layer written once, in dependency order."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Collection, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass, replace
from datetime import datetime
from functools import cached_property

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from reportstar.plans import bridges, dims, fact, keys, measures, staging, texts
from reportstar.sinks.store import Store
from reportstar.sources.raw import RawTables, feed_fingerprint

LABEL_DIM_TABLES = {d: f"dim_{d}" for d in dims.LABEL_COLUMNS}
STAR_INFO = "star_info"
#: The report feed once more, for the model that reads its texts: others do with their key, if they are stored apart.
REPORTS_WITH_TEXTS = "raw_report_with_texts"
STAR_MEASURES = "star_measures"
#: To be raised when a model changes: tables of the old one are then not taken over.
MODELS_VERSION = "4"
STAR_TABLES = (
    "stg_adversary", "stg_entity", "adversary_links", "stg_report", "report_text", "stg_report_adversary",
    "dim_key", *LABEL_DIM_TABLES.values(), "dim_adversary", "dim_entity", "entity_lookup",
    "fact_report", "bridge_country", "bridge_entity", "bridge_group_adversary",
    "bridge_adversary", "bridge_adversary_country",
)


@dataclass(frozen=True)
class Star:
    """The stored tables, by name, and what is known about them."""

    tables: Mapping[str, DataFrame]
    unique_report_ids: bool
    as_of: datetime
    #: relation, measure, value as observed by the build; None: it stored none.
    measures: DataFrame | None = None
    #: The fact as it is stored, with the key of its texts; None: its texts are in its rows.
    fact_keyed: DataFrame | None = None

    def __getitem__(self, name: str) -> DataFrame:
        return self.tables[name]

    @property
    def reports(self) -> DataFrame:
        """The fact for whoever reads no texts; it may hold them or not."""
        return self.tables["fact_report"] if self.fact_keyed is None else self.fact_keyed

    def label_dims(self) -> dict[str, DataFrame]:
        return {d: self.tables[table] for d, table in LABEL_DIM_TABLES.items()}


def report_ids_are_unique(stg_report: DataFrame) -> bool:
    """Whether no report id is NULL or used twice. Counts per id are combined map-side and
    nothing but one row reaches the driver."""
    repeated = (
        stg_report.groupBy("report_id")
        .count()
        .filter(F.col("report_id").isNull() | (F.col("count") > 1))
    )
    return repeated.isEmpty()


def _fact_keyed(tables: Mapping[str, DataFrame]) -> DataFrame | None:
    fact_report = tables["fact_report"]
    return fact_report if texts.TEXT_KEY in fact_report.columns else None


def _shown(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The tables as readers see them: the fact with its texts, staged sets with their keys."""
    return {name: staging.with_set_keys(name, tables[name]) for name in STAR_TABLES} | {"fact_report": _fact_shown(tables)}


def _fact_shown(tables: Mapping[str, DataFrame]) -> DataFrame:
    keyed = _fact_keyed(tables)
    if keyed is None:
        return tables["fact_report"]
    return texts.with_texts(keyed, tables["report_text"]).drop(texts.TEXT_KEY)


@dataclass(frozen=True)
class Model:
    """How a table is made of others. `dated`: the build time is in its rows."""

    reads: tuple[str, ...]
    build: Callable[[Mapping[str, DataFrame], Build], DataFrame]
    dated: bool = True


@dataclass(frozen=True)
class Build:
    """What holds for all models of a run."""

    as_of: datetime
    report_type: str
    #: Given while a table is made.
    scratch: Callable[[str], Callable[[DataFrame], DataFrame]] | None = None


def _label_dim(dimension: str) -> Model:
    return Model(("dim_key",), lambda t, b: dims.label_dimension(t["dim_key"], dimension, b.as_of))


def _bridge(build: Callable[..., DataFrame], *reads: str) -> Model:
    return Model(reads, lambda t, b: build(*(t[r] for r in reads), b.as_of))


def _with_adversaries(t: Mapping[str, DataFrame], _: Build) -> DataFrame:
    return staging.with_adversaries(t["stg_report"].select("row_key", "report_id"), t["adversary_links"])


def _fact(t: Mapping[str, DataFrame], b: Build) -> DataFrame:
    label_dims = {d: t[table] for d, table in LABEL_DIM_TABLES.items()}
    staged = (staging.with_set_keys(name, t[name]) for name in ("stg_report", "stg_report_adversary"))
    return fact.report_fact(*staged, label_dims, b.as_of, b.scratch("fact_positions"))


# Models of one layer do not read each other. `dim_key`, which grows, comes after the first. Those that deal all reports, or
# the members of all their sets, stand alone: else the shuffle files of all of them would lie on disk side by side.
STAGING: dict[str, Model] = {
    "stg_adversary": Model(("raw_adversary",), lambda t, b: staging.adversary_targets(t["raw_adversary"]), False),
    "adversary_links": Model(("raw_adversary",), lambda t, b: staging.link_adversaries(t["raw_adversary"]), False),
    "stg_entity": Model(
        ("raw_entity", "raw_report"),
        lambda t, b: staging.stage_entities(t["raw_entity"], t["raw_report"], b.report_type),
        False,
    ),
    "stg_report": Model(
        ("raw_report",),
        lambda t, b: fact.with_row_key(staging.stage_report_keys(t["raw_report"], b.report_type)),
        False,
    ),
    "report_text": Model(
        (REPORTS_WITH_TEXTS,),
        lambda t, b: texts.distinct_texts(staging.of_type(t[REPORTS_WITH_TEXTS], b.report_type)),
        False,
    ),
}
KEYED = ("stg_report", "stg_adversary", "stg_entity")
LAYERS: tuple[dict[str, Model], ...] = (
    {
        "stg_report_adversary": Model(("stg_report", "adversary_links"), _with_adversaries, False),
        "dim_entity": _bridge(dims.entity_dimension, "dim_key", "stg_entity"),
        "dim_adversary": _bridge(dims.adversary_dimension, "dim_key", "stg_adversary"),
        **{table: _label_dim(d) for d, table in LABEL_DIM_TABLES.items()},
    },
    {"entity_lookup": Model(("dim_entity",), lambda t, b: bridges.entity_lookup(t["dim_entity"]))},
    {"fact_report": Model(("stg_report", "stg_report_adversary", *LABEL_DIM_TABLES.values()), _fact)},
    {"bridge_entity": _bridge(bridges.entity_bridge, "stg_report", "entity_lookup")},
    {"bridge_group_adversary": _bridge(bridges.group_bridge, "stg_report", "dim_adversary")},
    {
        "bridge_country": _bridge(bridges.country_bridge, "stg_report", "dim_country"),
        "bridge_adversary": _bridge(bridges.adversary_bridge, "stg_report_adversary", "dim_adversary"),
        "bridge_adversary_country": _bridge(bridges.adversary_country_bridge, "stg_adversary", "dim_country"),
    },
)


def tables_below(names: Collection[str]) -> set[str]:
    """These tables, all that they follow from, and the feeds."""
    models = {name: model for layer in (STAGING, *LAYERS) for name, model in layer.items()}
    found: set[str] = set()
    pending = [*names]
    while pending:
        name = pending.pop()
        if name not in found:
            found.add(name)
            pending += KEYED if name == "dim_key" else models[name].reads if name in models else ()
    return found


class _Run:
    """One run over a store: tables by name, and how each is made or taken over."""

    def __init__(self, store: Store, build: Build, tables: dict[str, DataFrame], feeds: Mapping[str, str | None]):
        self.store, self.build, self.tables, self.feeds = store, build, tables, feeds
        self.measured: dict[str, measures.Values] = {}

    def fingerprint(self, name: str, reads: Sequence[str], dated: bool) -> str | None:
        """Of all that the rows of a table follow from. None: unknown, so the table is made."""
        if not self.store.resumes:
            return None
        origins = [self.feeds[r] if r in self.feeds else self.store.identity(r) for r in reads]
        if None in origins:
            return None
        known = [MODELS_VERSION, name, self.build.report_type, *origins, str(self.build.as_of) if dated else ""]
        return hashlib.sha256("\0".join(known).encode()).hexdigest()

    def made(self, name: str, reads: Sequence[str], dated: bool, make: Callable[[], DataFrame]) -> DataFrame:
        return self._taken_or_made(name, self.fingerprint(name, reads, dated), make)

    def _taken_or_made(self, name: str, fingerprint: str | None, make: Callable[[], DataFrame]) -> DataFrame:
        if fingerprint and (found := self.store.kept(name, fingerprint)) is not None:
            if (known := self.store.noted(name)) is not None:
                self.measured[name] = known
            return found
        table = make()
        if fingerprint:
            self.store.keep(name, fingerprint, self.measured.get(name))
        return table

    def model(self, name: str, model: Model) -> DataFrame:
        def make() -> DataFrame:
            with _scratch(self.store) as scratch:
                rows = staging.without_set_keys(name, model.build(self.tables, replace(self.build, scratch=scratch)))
                if name not in measures.MEASURES:
                    return self.store.replace(name, rows)
                seen = Observation()
                table = self.store.replace(name, rows.observe(seen, *measures.columns(name)))
                self.measured[name] = seen.get
                return table

        return self.made(name, model.reads, model.dated, make)

    def measures(self) -> DataFrame:
        """Of all tables, scanned if some were taken over that have none. Numbers that an earlier run stored are taken
        over like any table."""
        if self.measured.keys() < measures.MEASURES.keys():
            return self.store.replace(STAR_MEASURES, measures.scanned(self.tables))
        known = json.dumps([STAR_MEASURES, self.measured], sort_keys=True)
        fingerprint = hashlib.sha256(known.encode()).hexdigest() if self.store.resumes else None
        return self._taken_or_made(
            STAR_MEASURES,
            fingerprint,
            lambda: self.store.replace(STAR_MEASURES, measures.rows(self.store.spark, self.measured)),
        )

    def refresh(self, models: Mapping[str, Model], chosen: Collection[str], pool: ThreadPoolExecutor) -> None:
        """Models of one layer do not read each other and are submitted together."""
        pending = {name: pool.submit(self.model, name, model) for name, model in models.items() if name in chosen}
        self.tables.update({name: job.result() for name, job in pending.items()})

    def registry(self) -> DataFrame:
        candidates = keys.key_candidates(*(self.tables[name] for name in KEYED))

        def make() -> DataFrame:
            with _scratch(self.store) as scratch:
                cut = scratch("key_positions")
                return self.store.extend(
                    "dim_key",
                    lambda existing: keys.register(candidates, existing, self.build.as_of, cut),
                    partition_by=["dimension"],
                )

        return self.made("dim_key", KEYED, False, make)


@contextmanager
def _scratch(store: Store) -> Iterator[Callable[[str], Callable[[DataFrame], DataFrame]]]:
    """Tables that a model needs while it is made; they go when it is written, or the next run overwrites them."""
    names: list[str] = []

    def scratch(name: str) -> Callable[[DataFrame], DataFrame]:
        names.append(f"scratch_{name}")
        return lambda df: store.replace(f"scratch_{name}", df)

    yield scratch
    for name in names:
        store.drop(name)


class StarOnDemand:
    """Reads like a `Star`. A table is written when it is first read, after all that it follows from, by the models of
    `build_star`: whoever asks for a dimension does not pay for bridges. `whole` is the complete star.

    `sources` gives the feeds by name, each called once at most, and the reports apart from and with their texts. They are
    made one after another. `staged` is called when all of staging is written: no table is made from the feeds after that.
    """

    def __init__(
        self,
        sources: Mapping[str, Callable[[], DataFrame]],
        store: Store,
        as_of: datetime,
        report_type: str = staging.REPORT_TYPE,
        parallel_models: int = 4,
        staged: Callable[[], None] = lambda: None,
    ):
        self.sources, self.as_of, self.parallel_models, self.staged = sources, as_of, parallel_models, staged
        self._run = _Run(store, Build(as_of, report_type), {}, dict.fromkeys(sources))

    def _made(self, *names: str) -> Mapping[str, DataFrame]:
        run = self._run
        missing = tables_below(names) - run.tables.keys()
        if not missing.isdisjoint(STAR_TABLES):
            run.tables.update({name: self.sources[name]() for name in self.sources if name in missing})
            with ThreadPoolExecutor(self.parallel_models) as pool:
                run.refresh(STAGING, missing, pool)
                if STAGING.keys() <= run.tables.keys():
                    self.staged()
                if "dim_key" in missing:
                    run.tables["dim_key"] = run.registry()
                for layer in LAYERS:
                    run.refresh(layer, missing, pool)
        return run.tables

    def __getitem__(self, name: str) -> DataFrame:
        if name == "fact_report":
            return _fact_shown(self._made(name, "report_text"))
        return staging.with_set_keys(name, self._made(name)[name])

    @property
    def fact_keyed(self) -> DataFrame | None:
        """With what its keys of texts stand for; `reports` is without."""
        return _fact_keyed(self._made("fact_report", "report_text"))

    @property
    def reports(self) -> DataFrame:
        return self._made("fact_report")["fact_report"]

    def label_dims(self) -> dict[str, DataFrame]:
        tables = self._made(*LABEL_DIM_TABLES.values())
        return {d: tables[table] for d, table in LABEL_DIM_TABLES.items()}

    @cached_property
    def unique_report_ids(self) -> bool:
        return report_ids_are_unique(self["stg_report"])

    @property
    def measures(self) -> DataFrame | None:
        return self.whole.measures

    @cached_property
    def whole(self) -> Star:
        run = self._run
        _mark_run(run.store, self.as_of, None)
        tables = self._made(*STAR_TABLES)
        star = Star(_shown(tables), self.unique_report_ids, self.as_of, run.measures(), _fact_keyed(tables))
        _mark_run(run.store, self.as_of, star.unique_report_ids)
        run.store.publish()
        return star


def build_star(
    raw: RawTables,
    store: Store,
    as_of: datetime,
    report_type: str = staging.REPORT_TYPE,
    parallel_models: int = 4,
    only: Collection[str] | None = None,
    feeds: Mapping[str, str] | None = None,
) -> Star:
    """Stage, register keys, build dimensions, fact and bridges into `store`.

    A second run over the same store refreshes every table and appends to the registry, so
    ids stay. Models of one layer do not read each other and are submitted together.

    Over a `RunStore` the star is published when it is complete: until then, and for good if the
    run breaks, readers get the run before. Tables of earlier runs on the same inputs are taken
    over. `feeds` tells the state of a feed ('raw_report', 'raw_adversary', 'raw_entity'), such
    as a snapshot id; by default it is taken from the feed's files, and a feed without files is
    always read. Over other stores one run at a time writes, and readers wait for its end.

    `only`: make these tables (and register keys if 'dim_key' is among them), take the others
    as the last complete run left them.

    Staged reports are two tables: `stg_report` with what a report says itself, written in
    one pass, and `stg_report_adversary` with who claims it. Both and the fact carry a key of
    the texts; `report_text` holds each set of texts once, and the star shows the fact with them.
    """
    sources = {"raw_report": raw.report, "raw_adversary": raw.adversary, "raw_entity": raw.entity}
    if unknown := set(only or ()) - set(STAR_TABLES):
        raise ValueError(f"no such tables: {', '.join(sorted(unknown))}")
    last = None if only is None else load_star(store.last_published() if store.resumes else store)
    known = {name: (feeds or {}).get(name) for name in sources}
    if store.resumes:
        known = {name: known[name] or feed_fingerprint(feed) for name, feed in sources.items()}

    chosen = STAR_TABLES if only is None else only
    known[REPORTS_WITH_TEXTS] = known["raw_report"]
    run = _Run(
        store, Build(as_of, report_type), {**sources, REPORTS_WITH_TEXTS: raw.report}, known
    )
    if last is not None:
        run.tables |= last.tables
        if store.resumes:
            store.tables |= store.last_published().tables
        if last.measures is not None:
            for row in last.measures.collect():
                run.measured.setdefault(row["relation"], {})[row["measure"]] = row["value"]
    _mark_run(store, as_of, None)
    with ThreadPoolExecutor(parallel_models) as pool:
        run.refresh(STAGING, chosen, pool)
        unique_report_ids = pool.submit(report_ids_are_unique, run.tables["stg_report"])
        if "dim_key" in chosen:
            run.tables["dim_key"] = run.registry()
        for layer in LAYERS:
            run.refresh(layer, chosen, pool)
        star = Star(_shown(run.tables), unique_report_ids.result(), as_of, run.measures(), _fact_keyed(run.tables))
    _mark_run(store, as_of, star.unique_report_ids)
    store.publish()
    return star


def _mark_run(store: Store, as_of: datetime, unique_report_ids: bool | None) -> None:
    """What a reader must know of the run that wrote the tables; NULL while it is open. It is
    the first table of a run and the last."""
    known = store.spark.range(1).select(
        F.lit(unique_report_ids).cast("boolean").alias("unique_report_ids"),
        F.lit(as_of).alias("as_of"),
    )
    store.replace(STAR_INFO, known)


def load_star(store: Store) -> Star:
    """The star of an earlier run, for sessions that only read. A run that has not ended, or
    failed, leaves tables of different runs side by side and is refused."""
    known = store.read(STAR_INFO).first()
    if known is None or known["unique_report_ids"] is None:
        raise RuntimeError("the last build has not ended; build again before reading")
    tables = {name: store.read(name) for name in STAR_TABLES}
    measured = store.read_if_exists(STAR_MEASURES)
    return Star(_shown(tables), known["unique_report_ids"], known["as_of"], measured, _fact_keyed(tables))
