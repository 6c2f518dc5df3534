"""Feature retrieval: as of a time, latest values, derived values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.columns import quoted, time_literal
from ..operators.asof import HIT, asof_join, lay_out, within_ttl
from ..operators.heavy import DEFAULT_POLICY, SkewPolicy
from ..operators.lookup import lookup_join
from ..session import scratch_dir
from ..sources.versions import Version, current, publish, read_current
from .feature_model import Catalog, FeatureView, OnDemandView, column_name

FOUND_AT = "__found_at"


def get_historical(
    rows: DataFrame,
    references: Sequence[str],
    catalog: Catalog,
    row_time: str = "event_timestamp",
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """``rows`` with each wanted feature as it was known at ``row_time``.

    Views on the same source and key share one as-of pass; what differs
    is how long they are valid, and that is decided afterwards: when the
    newest row is too old, so are all others. Extent and heavy keys are
    counted once for all sources that share their keys.
    """
    wanted, fetch, compute = catalog.resolve(references)
    groups: dict[tuple, list[FeatureView]] = {}
    for name in fetch:
        view = catalog.view(name)
        groups.setdefault((id(view.source), view.entity.join_keys), []).append(view)

    oldest = {g: max(v.ttl for v in views) if all(v.ttl for v in views) else None for g, views in groups.items()}
    tables = {g: views[0].source.read(rows.sparkSession) for g, views in groups.items()}
    layouts = {}
    for keys in dict.fromkeys(keys for _, keys in groups):
        alike = [(tables[g], groups[g][0].source.timestamp, oldest[g]) for g in groups if g[1] == keys]
        layouts[keys] = lay_out(rows, keys, row_time, alike, policy)

    out = rows
    for group, views in groups.items():
        source, keys = views[0].source, group[1]
        columns = list(dict.fromkeys(c for v in views for c in fetch[v.name]))
        ties = source.tie_breakers(tables[group], keys)
        found = asof_join(
            out, tables[group], keys, row_time, source.timestamp, columns, ties, policy, oldest[group], layouts[keys]
        )
        features = {}
        for view in views:
            valid = within_ttl(quoted(row_time), F.col(f"{HIT}.time"), view.ttl)
            for name in fetch[view.name]:
                inner = "time" if name == source.timestamp else name
                value = F.when(valid, F.col(HIT)[inner]).cast(view.schema[name].dataType)
                features[column_name(view.name, name)] = value
        out = found.withColumns(features).drop(HIT)
    return _with_on_demand(out, compute).select(*_result_columns(rows, wanted))


def materialize(
    view: FeatureView | Sequence[FeatureView], start: datetime | Column, end: datetime | Column, spark: SparkSession
) -> DataFrame:
    """The newest row of each key within ``start`` and ``end``, both included,
    with the features of one view, or of several on one source and key.

    An aggregate, so a key with many rows shrinks before the shuffle.
    """
    views = _alike(view)
    return _values(_newest(views, start, end, spark), views)


def _alike(view: FeatureView | Sequence[FeatureView]) -> list[FeatureView]:
    views = [view] if isinstance(view, FeatureView) else list(view)
    source, keys = views[0].source, views[0].entity.join_keys
    if any(v.source is not source or v.entity.join_keys != keys for v in views):
        raise ValueError("views of one snapshot share their source and key")
    fields = {f.name: f for v in views for f in v.schema}
    if any(fields[f.name].dataType != f.dataType for v in views for f in v.schema):
        raise ValueError("views of one snapshot agree on the types of their features")
    return views


def _newest(views: Sequence[FeatureView], start, end, spark: SparkSession) -> DataFrame:
    """Keys and a struct that sorts by time, then by what decides between equal
    times: the greatest of each key."""
    source, keys = views[0].source, views[0].entity.join_keys
    time = quoted(source.timestamp)
    table = source.read(spark)
    kind = table.schema[source.timestamp].dataType
    low, high = (b if isinstance(b, Column) else time_literal(b, kind) for b in (start, end))
    rest = dict.fromkeys([*source.tie_breakers(table, keys), *(f.name for v in views for f in v.schema)])
    row = F.struct(time.alias("time"), *[quoted(c).alias(c) for c in rest if c != source.timestamp])
    return table.filter(time.between(low, high)).groupBy(*[quoted(k) for k in keys]).agg(F.max(row).alias(HIT))


def _values(newest: DataFrame, views: Sequence[FeatureView]) -> DataFrame:
    source, keys = views[0].source, views[0].entity.join_keys
    fields = {f.name: f for v in views for f in v.schema}
    values = [
        F.col(HIT)["time" if f.name == source.timestamp else f.name].cast(f.dataType).alias(f.name)
        for f in fields.values()
    ]
    return newest.select(*[quoted(k) for k in keys], *values, F.col(f"{HIT}.time").alias(FOUND_AT))


def write_snapshot(view: FeatureView | Sequence[FeatureView], start, end, root: str, spark: SparkSession) -> Version:
    """The materialized view or views, added to the snapshot at ``root``.

    Ranges may come in any order and overlap: of a key's rows the newest stays,
    of equal times the one the tie breakers prefer, so that late, older rows
    win nothing and a range given twice changes nothing. The result is what one
    call over all ranges would give. It is a new version; readers of the one
    before are not disturbed, a failed run leaves it, and of two runs at once
    one is told to try again (``VersionConflict``).
    """
    views = _alike(view)
    before = current(spark, root)
    newest = _newest(views, start, end, spark)
    if before:
        kept = spark.read.parquet(before.path)
        if _shape(kept) != _shape(newest):
            raise ValueError(f"the snapshot at {root} holds {kept.schema[HIT].dataType.simpleString()}, not {newest.schema[HIT].dataType.simpleString()}")
        keys = [quoted(k) for k in views[0].entity.join_keys]
        newest = kept.unionByName(newest).groupBy(*keys).agg(F.max(HIT).alias(HIT))
    return publish(newest, root, after=before)


def _shape(newest: DataFrame) -> list[tuple[str, str]]:
    """Names and types without what may be NULL: files do not keep that."""
    return [(f.name, f.dataType.simpleString()) for f in newest.schema]


def read_snapshot(view: FeatureView | Sequence[FeatureView], root: str, spark: SparkSession) -> DataFrame:
    """The newest version of a snapshot, as ``materialize`` would give it."""
    return _values(read_current(spark, root), _alike(view))


def get_online(
    rows: DataFrame,
    references: Sequence[str],
    catalog: Catalog,
    snapshots: Mapping[str, DataFrame],
    as_of: Column | None = None,
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """``rows`` with the latest value of each wanted feature.

    ``snapshots`` holds the materialized table of each stored view; views that
    are given the same table take one join. With
    ``as_of`` values older than the view's time to live come back as NULL.
    """
    wanted, fetch, compute = catalog.resolve(references)
    groups: dict[tuple, list[str]] = {}
    for name in fetch:
        groups.setdefault((id(snapshots[name]), catalog.view(name).entity.join_keys), []).append(name)
    out = rows
    for (_, keys), names in groups.items():
        values = []
        for name in names:
            ttl, fresh = catalog.view(name).ttl, F.lit(True)
            if as_of is not None and ttl:
                fresh = F.col(FOUND_AT) >= as_of - F.lit(ttl)
            values += [F.when(fresh, quoted(f)).alias(column_name(name, f)) for f in fetch[name]]
        out = lookup_join(out, snapshots[names[0]].select(*[quoted(k) for k in keys], *values), keys, policy)
    return _with_on_demand(out, compute).select(*_result_columns(rows, wanted))


def _with_on_demand(df: DataFrame, views: Sequence[OnDemandView]) -> DataFrame:
    if any(view.over_batch for view in views):
        path = scratch_dir(df.sparkSession, "batch")
        df.write.option("compression", "zstd").parquet(path)
        df = df.sparkSession.read.schema(df.schema).parquet(path)
    out = df
    for view in views:
        made = view.transform(out)
        if isinstance(made, DataFrame):
            # The rows stay the same ones as long as their columns do: the
            # table itself goes on, and nothing is joined to it.
            lost = [c for c in out.columns if c not in made.columns]
            added = [c for c in made.columns if c not in out.columns]
            if lost or sorted(added) != sorted(view.schema.names):
                raise ValueError(f"{view.name} must keep its rows' columns and add {view.schema.names}; lost {lost}, added {sorted(added)}")
            out = made.withColumnsRenamed({n: column_name(view.name, n) for n in added})
        else:
            made = dict(made)
            if set(made) != set(view.schema.names):
                raise ValueError(f"{view.name} must return {view.schema.names}, not {sorted(made)}")
            out = out.withColumns({column_name(view.name, n): c for n, c in made.items()})
        for declared in view.schema:
            actual = out.schema[column_name(view.name, declared.name)].dataType
            if actual != declared.dataType:
                raise TypeError(f"{view.name}:{declared.name} is {actual}, declared {declared.dataType}")
    return out


def _result_columns(rows: DataFrame, wanted: Sequence[str]) -> list[Column]:
    return [*[quoted(c) for c in rows.columns], *[quoted(c) for c in dict.fromkeys(wanted)]]


def latest_entities(features: DataFrame, keys: Sequence[str], timestamp: str, k: int | None = None) -> DataFrame:
    """The first ``k`` keys in order, all without ``k``, each with its latest time."""
    names = [quoted(c) for c in keys]
    latest = features.groupBy(*names).agg(F.max(quoted(timestamp)).alias(timestamp))
    return latest if k is None else latest.orderBy(*names).limit(k)
