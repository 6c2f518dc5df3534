"""What a feature is: plain objects, no registry."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession, types as T


@dataclass(frozen=True)
class Entity:
    name: str
    join_keys: tuple[str, ...]


@dataclass(frozen=True, eq=False)
class Source:
    """A table of feature rows: a Parquet path, or a DataFrame.

    ``created`` names the column that decides between rows of one key and
    time. Where it is equal, or not given, the columns in ``ties`` decide,
    all remaining ones by default, so that every request picks the same
    row. A wide source whose rows differ in time reads less with ``ties=()``.
    """

    name: str
    timestamp: str
    path: str | None = None
    table: DataFrame | None = None
    created: str | None = None
    ties: tuple[str, ...] | None = None

    def tie_breakers(self, table: DataFrame, keys: Sequence[str]) -> list[str]:
        first = [self.created] if self.created else []
        rest = table.columns if self.ties is None else self.ties
        return list(dict.fromkeys(c for c in [*first, *rest] if c not in (*keys, self.timestamp)))

    def read(self, spark: SparkSession) -> DataFrame:
        if self.table is not None:
            return self.table
        return spark.read.parquet(self.path)


@dataclass(frozen=True, eq=False)
class FeatureView:
    """Typed fields of a source, valid for ``ttl`` from their time on."""

    name: str
    entity: Entity
    schema: T.StructType
    source: Source
    ttl: timedelta | None = None
    tags: Mapping[str, str] = field(default_factory=dict)


@dataclass(frozen=True, eq=False)
class OnDemandView:
    """Fields computed from the features of other views.

    ``transform`` gets the table of all rows asked for together, with
    columns named ``view__feature``, and returns one column per field, or that
    table with the fields added as columns of their own names. It may aggregate
    over the table, through ``.scalar()`` or a join; ``over_batch`` says that it
    does: the table is then written once and read from there, so that what was
    looked up for it is not looked up again for each use.
    """

    name: str
    sources: tuple[FeatureView, ...]
    schema: T.StructType
    transform: Callable[[DataFrame], Mapping[str, Column] | DataFrame]
    over_batch: bool = False


def column_name(view: str, feature: str) -> str:
    """Name of a feature in results. The view's name keeps a feature apart
    from a column of the rows that happens to have the same name."""
    return f"{view}__{feature}"


def split_reference(reference: str) -> tuple[str, str]:
    view, colon, feature = reference.partition(":")
    if not (view and colon and feature):
        raise ValueError(f"a feature is named view:feature, not {reference!r}")
    return view, feature


class Catalog:
    """The views known by name."""

    def __init__(self, views: Sequence[FeatureView], on_demand: Sequence[OnDemandView] = ()):
        self.views = {v.name: v for v in views}
        self.on_demand = {v.name: v for v in on_demand}
        if len({*self.views, *self.on_demand}) != len(views) + len(on_demand):
            raise ValueError("view names must differ")

    def resolve(self, references: Sequence[str]):
        """The wanted columns in order, the features to fetch per stored
        view, and the on-demand views to compute."""
        wanted: list[str] = []
        fetch: dict[str, list[str]] = {}
        compute: list[OnDemandView] = []
        for reference in references:
            view, feature = split_reference(reference)
            wanted.append(column_name(view, feature))
            if view in self.views:
                self._add(fetch, self.views[view], feature)
            elif view in self.on_demand:
                derived = self.on_demand[view]
                _field(derived, feature)
                if derived not in compute:
                    compute.append(derived)
                for source in derived.sources:
                    for name in source.schema.names:
                        self._add(fetch, source, name)
            else:
                raise KeyError(f"no view named {view!r}")
        return wanted, fetch, compute

    @staticmethod
    def _add(fetch: dict[str, list[str]], view: FeatureView, feature: str) -> None:
        _field(view, feature)
        names = fetch.setdefault(view.name, [])
        if feature not in names:
            names.append(feature)

    def view(self, name: str) -> FeatureView:
        return self.views[name]


def _field(view: FeatureView | OnDemandView, feature: str) -> T.StructField:
    if feature not in view.schema.names:
        raise KeyError(f"view {view.name!r} has no feature {feature!r}")
    return view.schema[feature]
