"""Which marts exist, how they are stored and which groups are built."""

from __future__ import annotations

import logging
from collections.abc import Callable, Collection, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from skyair.plans import marts

log = logging.getLogger(__name__)

STAGING = ("staging_readings", "staging_flights")


@dataclass(frozen=True)
class Model:
    """A mart: ``build`` receives a function that returns a staging view or an earlier mart by name."""

    name: str
    group: str
    build: Callable[[Callable[[str], DataFrame]], DataFrame]
    reads: tuple[str, ...]


def default_models(countries: DataFrame | None = None) -> tuple[Model, ...]:
    """The marts in order: one comes after those it reads. ``countries`` is for the correlation."""
    correlation = Model(
        "flight_air_correlation",
        "correlation",
        lambda t: marts.correlation(t("daily_summary"), t("staging_flights"), countries=countries),
        ("daily_summary", "staging_flights"),
    )
    return (*_SINGLE, correlation)


_SINGLE = (
    Model("daily_summary", "batch", lambda t: marts.daily_summary(t("staging_readings")), ("staging_readings",)),
    Model("polluted_days", "batch", lambda t: marts.polluted_days(t("daily_summary")), ("daily_summary",)),
    Model("latest_states", "streaming", lambda t: marts.latest_states(t("staging_flights")), ("staging_flights",)),
)
MODELS = default_models()
GROUPS = ("batch", "streaming", "correlation")


def build_models(
    spark: SparkSession,
    staging: Mapping[str, DataFrame],
    save: Callable[[DataFrame, str], None],
    groups: Collection[str] = GROUPS,
    models: Collection[Model] = MODELS,
) -> list[str]:
    """Register staging frames as temporary views and store every enabled mart as a table.

    A mart whose inputs are absent (a source was skipped, or an earlier mart is neither built now nor
    stored from before) is left out. Later marts read the stored table of an earlier one, so it is
    computed once. Returns the names built.
    """
    for name, frame in staging.items():
        frame.createOrReplaceTempView(name)
    built = []
    for model in models:
        present = all(
            name in staging or (name not in STAGING and spark.catalog.tableExists(name)) for name in model.reads
        )
        if model.group in groups and present:
            for name in model.reads:
                if name not in staging and name not in built:
                    log.warning("%s reads %s as an earlier run left it", model.name, name)
            save(model.build(spark.table), model.name)
            built.append(model.name)
    return built
