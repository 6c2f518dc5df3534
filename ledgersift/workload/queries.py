"""One query per capability. Each takes the session and the table folder."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.columns import TIMESTAMP_FORMAT, is_unparsable, time_literal
from ..operators import checks, dedupe, increments, sigma, stats, trends
from ..operators.heavy import SkewPolicy
from ..operators.lookup import with_group_max
from ..plans import clean as cleaning
from ..plans.driver_features import driver_catalog
from ..plans.feature_model import Catalog, Entity, FeatureView, Source
from ..plans.features import get_historical, get_online, latest_entities, materialize, read_snapshot, write_snapshot
from ..plans.profile import profile, profile_text
from ..session import scratch_dir
from ..sources.files import select_files
from ..sources.typed import typed_copy
from ..sources.versions import read_current
from ..sources.transactions import TRANSACTION_COLUMNS, default_output, read_transactions, write_clean
from .tables import driver_stats, entities, orders_by_day, table, tx_raw

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# The parameters the SQL texts repeat.
AS_OF = datetime(2024, 1, 15)
START, MIDDLE, END = datetime(2024, 1, 5), datetime(2024, 1, 9), datetime(2024, 1, 15)
SHORT_TTL, MEDIUM_TTL, SPENDING_TTL = timedelta(hours=36), timedelta(days=3), timedelta(days=60)
REFERENCES = [
    "driver_stats:conv_rate",
    "driver_stats:acc_rate",
    "driver_stats:avg_daily_trips",
    "driver_activity:event_timestamp",
    "driver_activity:created",
    "activity_score:activity_score",
]
STATS = REFERENCES[:3]


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _rounded(df: DataFrame, digits: int = 6, only: list[str] | None = None) -> DataFrame:
    """Results of floating-point sums depend on their order; compare rounded."""
    names = only or [f.name for f in df.schema if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns({n: F.round(n, digits) for n in names})


def _text_table(spark: SparkSession, sf_dir: str) -> str:
    """The raw transactions as text, one folder per day named like a file.

    Rebalancing lets several tasks write a day that holds many rows.
    """
    root = scratch_dir(spark, "text")
    raw = tx_raw(spark, sf_dir).withColumn("tx_datetime", F.date_format("tx_datetime", TIMESTAMP_FORMAT))
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.col("tx_time_days"))
    lines = raw.select(
        F.to_csv(F.struct(*TRANSACTION_COLUMNS)).alias("value"),
        F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit(".txt")).alias("day"),
    )
    heads = lines.select(F.lit("# " + ", ".join(TRANSACTION_COLUMNS)).alias("value"), "day").distinct()
    heads.unionByName(lines).hint("rebalance", "day").write.partitionBy("day").text(root)
    spark.range(1).select(F.lit("not a transaction").alias("value")).write.text(f"{root}/notes.md")
    return root


# -- sources and sinks ------------------------------------------------------


@query
def src_csv_roundtrip(spark, sf_dir):
    root = _text_table(spark, sf_dir)
    return read_transactions(spark, select_files(spark, root, "all"), ntz=True)


@query
def src_glob_union(spark, sf_dir):
    return read_transactions(spark, _text_table(spark, sf_dir) + "/*.txt", ntz=True)


@query
def src_csv_malformed(spark, sf_dir):
    """Rows and unreadable lines when every tenth line is written otherwise:
    in ways that are read all the same, or that are not."""
    raw = tx_raw(spark, sf_dir).withColumn("tx_datetime", F.date_format("tx_datetime", TIMESTAMP_FORMAT))
    line = F.to_csv(F.struct(*TRANSACTION_COLUMNS))
    way = F.when(F.col("transaction_id") % 10 == 0, F.floor(F.col("transaction_id") / 10) % 5)
    written = (
        F.when(way == 0, F.regexp_replace(line, r"(:\d\d),", "$1.25,"))
        .when(way == 1, F.regexp_replace(line, r"(\d) (\d)", "$1T$2"))
        .when(way == 2, F.regexp_replace(line, r"(:\d\d),(\d+),", "$1,$2.0,"))
        .when(way == 3, F.regexp_replace(line, r"\d:\d\d,", "never,"))
        .when(way == 4, F.concat(line, F.lit(",1")))
        .otherwise(line)
    )
    root = scratch_dir(spark, "malformed")
    raw.select(written.alias("value")).write.text(root)
    read = read_transactions(spark, root, ntz=True, corrupt_column="line")
    return read.groupBy(F.col("line").isNotNull().alias("unreadable")).agg(
        F.count(F.lit(1)).alias("lines"), F.sum("customer_id").alias("customers"), F.count("tx_datetime").alias("times")
    )


@query
def src_rejects(spark, sf_dir):
    """Every line once: as a row or, with its text, as a reject."""
    raw = tx_raw(spark, sf_dir).withColumn("tx_datetime", F.date_format("tx_datetime", TIMESTAMP_FORMAT))
    line = F.to_csv(F.struct(*TRANSACTION_COLUMNS))
    root = scratch_dir(spark, "rejects")
    raw.select(F.when(F.col("transaction_id") % 10 == 3, F.regexp_replace(line, r"\d:\d\d,", "never,")).otherwise(line).alias("value")).write.text(root)
    with typed_copy(spark, root, ntz=True, path=scratch_dir(spark, "typed")) as copy:
        number = F.substring_index("line", ",", 1).cast("long")
        own = F.col("file").contains(root.rsplit("/", 1)[-1])
        rows = copy.readable.select("transaction_id", F.lit(False).alias("rejected"), F.lit(True).alias("named"))
        return rows.unionByName(copy.rejects.select(number.alias("transaction_id"), F.lit(True).alias("rejected"), own.alias("named")))


@query
def src_select_latest(spark, sf_dir):
    root = _text_table(spark, sf_dir)
    return read_transactions(spark, select_files(spark, root, "latest"), ntz=True)


@query
def src_select_first_n(spark, sf_dir):
    root = _text_table(spark, sf_dir)
    return read_transactions(spark, select_files(spark, root, 3), ntz=True)


@query
def sink_parquet_roundtrip(spark, sf_dir):
    path = default_output(scratch_dir(spark, "raw"))
    write_clean(tx_raw(spark, sf_dir), path)
    return spark.read.parquet(path)


@query
def sink_versioned_roundtrip(spark, sf_dir):
    """A second version replaces a first that holds only part of the rows."""
    path, raw = scratch_dir(spark, "versioned"), tx_raw(spark, sf_dir)
    write_clean(raw.filter("tx_fraud = 1"), path, versioned=True)
    write_clean(raw, path, ["tx_time_days"], versioned=True)
    return read_current(spark, path).select(*TRANSACTION_COLUMNS)


@query
def sink_partitioned_roundtrip(spark, sf_dir):
    path = default_output(scratch_dir(spark, "daily"))
    write_clean(tx_raw(spark, sf_dir), path, ["tx_time_days"])
    return spark.read.parquet(path).select(*TRANSACTION_COLUMNS)


# -- profile ----------------------------------------------------------------


@query
def prof_nulls(spark, sf_dir):
    return stats.null_counts(tx_raw(spark, sf_dir))


@query
def prof_amount_stats(spark, sf_dir):
    return _rounded(stats.numeric_stats(tx_raw(spark, sf_dir), "tx_amount"))


@query
def prof_days_range(spark, sf_dir):
    return stats.value_range(tx_raw(spark, sf_dir), "tx_time_days")


@query
def prof_distinct_exact(spark, sf_dir):
    return stats.distinct_counts(tx_raw(spark, sf_dir), DISTINCT)


@query
def prof_distinct_approx(spark, sf_dir):
    """Per column the exact number, and whether the sketch comes near enough.

    Sketches differ from run to run; that they keep to three times their
    stated error does not.
    """
    raw = tx_raw(spark, sf_dir)
    exact = stats.distinct_counts(raw, DISTINCT)
    sketch = stats.distinct_counts(raw, DISTINCT, approximate=True)
    pair = lambda c: F.struct(F.lit(c).alias("column"), F.col(f"e.unique_{c}").alias("n"), F.col(f"s.unique_{c}").alias("s"))
    both = exact.select(F.struct("*").alias("e")).withColumn("s", sketch.select(F.struct("*").alias("s")).scalar())
    near = F.abs(F.col("s") - F.col("n")) <= 3 * stats.SKETCH_ERROR * F.col("n")
    return both.select(F.inline(F.array(*[pair(c) for c in DISTINCT]))).select("column", "n", near.alias("near"))


DISTINCT = ["customer_id", "terminal_id", "tx_fraud", "tx_fraud_scenario"]


@query
def prof_fraud_dist(spark, sf_dir):
    return stats.value_counts(tx_raw(spark, sf_dir), "tx_fraud")


@query
def prof_scenario_dist(spark, sf_dir):
    return stats.value_counts(tx_raw(spark, sf_dir), "tx_fraud_scenario")


@query
def prof_outliers(spark, sf_dir):
    return _rounded(sigma.sigma_summary(tx_raw(spark, sf_dir), "tx_amount"))


@query
def prof_outlier_rows(spark, sf_dir):
    return sigma.sigma_outliers(tx_raw(spark, sf_dir), "tx_amount")


@query
def prof_time_skew_top(spark, sf_dir):
    return checks.clock_skew_top(tx_raw(spark, sf_dir))


@query
def prof_bad_timestamps(spark, sf_dir):
    text = F.when(F.col("transaction_id") % 211 == 0, F.lit("bad")).otherwise(
        F.date_format("tx_datetime", TIMESTAMP_FORMAT)
    )
    return checks.check(tx_raw(spark, sf_dir), "bad_timestamps", is_unparsable(text))


@query
def prof_all_checks(spark, sf_dir):
    return _rounded(profile(tx_raw(spark, sf_dir), time_literal(AS_OF, T.TimestampNTZType())))


@query
def prof_text_once(spark, sf_dir):
    """The same numbers from text that is parsed once."""
    text = _text_table(spark, sf_dir) + "/*.txt"
    return _rounded(profile_text(spark, text, scratch_dir(spark, "profile"), time_literal(AS_OF, T.TimestampNTZType()), ntz=True))


@query
def prof_moments_merged(spark, sf_dir):
    """Mean, deviation and bounds of the amounts from one row a day."""
    days = increments.moments(tx_raw(spark, sf_dir), "tx_amount", ["tx_time_days"])
    return _rounded(increments.merged_bounds(days))


@query
def prof_distinct_merged(spark, sf_dir):
    """Exact counts, and whether sketches merged over the days come near."""
    raw, names = tx_raw(spark, sf_dir), ["customer_id", "terminal_id", "tx_fraud", "tx_fraud_scenario"]
    days = increments.sketches(raw, names, ["tx_time_days"])
    guess = increments.merged_distinct(days, names).select(F.struct("*")).scalar()
    exact = stats.distinct_counts(raw, names)
    error = 3 * 1.04 / 2 ** (increments.SKETCH_BITS / 2)
    lines = [F.struct(F.lit(n).alias("column"), F.col(f"unique_{n}").alias("n"), (F.abs(guess[f"unique_{n}"] - F.col(f"unique_{n}")) <= F.greatest(F.lit(0.5), error * F.col(f"unique_{n}"))).alias("near")) for n in names]
    return exact.select(F.inline(F.array(*lines)))


@query
def clean_sigma_merged(spark, sf_dir):
    """The trim with bounds from one row a day: no row is read for them twice."""
    raw = tx_raw(spark, sf_dir)
    days = increments.moments(raw, "tx_amount", ["tx_time_days"])
    return increments.trim_by(raw, "tx_amount", increments.merged_bounds(days))


# -- checks -----------------------------------------------------------------


@query
def check_dup_rows(spark, sf_dir):
    return dedupe.surplus_count(tx_raw(spark, sf_dir))


@query
def check_dup_rows_exceptall(spark, sf_dir):
    raw = tx_raw(spark, sf_dir)
    surplus = dedupe.multiset_except(raw, dedupe.dedupe_full(raw))
    return surplus.agg(F.count(F.lit(1)).alias("surplus_rows"))


@query
def set_multiset_difference(spark, sf_dir):
    raw = tx_raw(spark, sf_dir)
    return dedupe.multiset_except(raw, dedupe.dedupe_full(raw))


@query
def set_surplus_rows(spark, sf_dir):
    return dedupe.surplus_rows(tx_raw(spark, sf_dir))


@query
def check_dup_keys(spark, sf_dir):
    keys = dedupe.repeated_keys(tx_raw(spark, sf_dir), ["transaction_id"])
    return keys.agg(F.count(F.lit(1)).alias("repeated_keys"))


@query
def check_negative_amount(spark, sf_dir):
    return checks.check(tx_raw(spark, sf_dir), "negative_amount", checks.negative("tx_amount"))


@query
def check_zero_amount(spark, sf_dir):
    return checks.check(tx_raw(spark, sf_dir), "zero_amount", checks.zero("tx_amount"))


@query
def check_negative_customer(spark, sf_dir):
    return checks.check(tx_raw(spark, sf_dir), "negative_customer", checks.negative("customer_id"))


@query
def check_zero_customer(spark, sf_dir):
    return checks.check(tx_raw(spark, sf_dir), "zero_customer", checks.zero("customer_id"))


@query
def check_future_dates(spark, sf_dir):
    later = checks.in_future(as_of=time_literal(AS_OF, T.TimestampNTZType()))
    return checks.check(tx_raw(spark, sf_dir), "future_dates", later)


@query
def check_fraud_consistency(spark, sf_dir):
    return checks.check(tx_raw(spark, sf_dir), "scenario_without_fraud", checks.scenario_without_fraud())


# -- cleaning ---------------------------------------------------------------


@query
def clean_dropna(spark, sf_dir):
    return cleaning.drop_incomplete(tx_raw(spark, sf_dir))


@query
def clean_dedup_full(spark, sf_dir):
    return dedupe.dedupe_full(tx_raw(spark, sf_dir))


@query
def clean_dedup_key(spark, sf_dir):
    return cleaning.one_per_transaction(tx_raw(spark, sf_dir))


@query
def clean_dedup_key_lineitem(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return dedupe.dedupe_by_key(lines, ["l_orderkey", "l_linenumber"], ["l_shipdate"])


@query
def clean_positive(spark, sf_dir):
    return tx_raw(spark, sf_dir).filter(checks.positive("tx_amount") & checks.positive("customer_id"))


@query
def clean_sigma(spark, sf_dir):
    return sigma.sigma_trim(tx_raw(spark, sf_dir), "tx_amount")


@query
def clean_pipeline_a(spark, sf_dir):
    return cleaning.clean(tx_raw(spark, sf_dir), cleaning.SIGMA_FIRST)


@query
def clean_pipeline_b(spark, sf_dir):
    return cleaning.clean(tx_raw(spark, sf_dir), cleaning.CUSTOMER_FIRST)


@query
def clean_report(spark, sf_dir):
    return _rounded(cleaning.clean_report(tx_raw(spark, sf_dir), cleaning.CUSTOMER_FIRST))


@query
def clean_report_sigma_first(spark, sf_dir):
    return _rounded(cleaning.clean_report(tx_raw(spark, sf_dir), cleaning.SIGMA_FIRST))


# -- trends -----------------------------------------------------------------


@query
def fraud_by_day(spark, sf_dir):
    return trends.fraud_by_day(tx_raw(spark, sf_dir))


@query
def fraud_by_day_cleaned(spark, sf_dir):
    return trends.fraud_by_day(cleaning.clean(tx_raw(spark, sf_dir), cleaning.CUSTOMER_FIRST))


@query
def tx_by_hour(spark, sf_dir):
    return trends.tx_by_hour(tx_raw(spark, sf_dir))


# -- features ---------------------------------------------------------------


def _catalog(spark, sf_dir, stats_ttl=timedelta(days=365), activity_ttl=timedelta(days=30), batch=False):
    source = Source("driver_stats_source", "event_timestamp", table=driver_stats(spark, sf_dir), created="created")
    # Doubles rather than floats, so that both engines hold the same values.
    schema = T.StructType(
        [
            T.StructField("conv_rate", T.DoubleType()),
            T.StructField("acc_rate", T.DoubleType()),
            T.StructField("avg_daily_trips", T.IntegerType()),
        ]
    )
    return driver_catalog(source, stats_ttl, activity_ttl, schema, T.TimestampNTZType(), batch=batch)


@query
def feat_source_profile(spark, sf_dir):
    return stats.column_summary(driver_stats(spark, sf_dir))


@query
def feat_entity_latest(spark, sf_dir):
    return latest_entities(driver_stats(spark, sf_dir), ["driver_id"], "event_timestamp", k=3)


@query
def feat_entity_frame(spark, sf_dir):
    return latest_entities(driver_stats(spark, sf_dir), ["driver_id"], "event_timestamp")


@query
def feat_group_max(spark, sf_dir):
    rows = driver_stats(spark, sf_dir)
    return _rounded(with_group_max(rows, ["driver_id"], "event_timestamp", "latest"))


@query
def feat_historical(spark, sf_dir):
    return _rounded(get_historical(entities(spark, sf_dir), STATS, _catalog(spark, sf_dir)))


@query
def feat_historical_ttl(spark, sf_dir):
    return _rounded(get_historical(entities(spark, sf_dir), STATS, _catalog(spark, sf_dir, SHORT_TTL)))


@query
def feat_historical_sliced(spark, sf_dir):
    """As ``feat_historical_ttl``, with keys of 40 rows or more dealt out in ranges."""
    policy = SkewPolicy(heavy_rows=40)
    catalog = _catalog(spark, sf_dir, SHORT_TTL)
    return _rounded(get_historical(entities(spark, sf_dir), STATS, catalog, policy=policy))


@query
def feat_historical_multi(spark, sf_dir):
    catalog = _catalog(spark, sf_dir, MEDIUM_TTL, SHORT_TTL)
    return _rounded(get_historical(entities(spark, sf_dir), REFERENCES, catalog))


@query
def feat_historical_two_sources(spark, sf_dir):
    """Features of drivers, and of the customers of the same numbers."""
    view = FeatureView(
        "spending",
        Entity("driver", ("driver_id",)),
        T.StructType([T.StructField("n_orders", T.LongType()), T.StructField("spent", T.DoubleType())]),
        Source("orders_source", "event_timestamp", table=orders_by_day(spark, sf_dir)),
        SPENDING_TTL,
    )
    catalog = _catalog(spark, sf_dir, SHORT_TTL)
    both = Catalog([*catalog.views.values(), view], list(catalog.on_demand.values()))
    return _rounded(get_historical(entities(spark, sf_dir), [*STATS, "spending:n_orders", "spending:spent"], both))


@query
def feat_activity_score(spark, sf_dir):
    catalog = _catalog(spark, sf_dir, SHORT_TTL)
    return _rounded(get_historical(entities(spark, sf_dir), REFERENCES[-1:], catalog))


@query
def feat_activity_score_batch(spark, sf_dir):
    """The score as a function from table to table, over a batch written once."""
    catalog = _catalog(spark, sf_dir, SHORT_TTL, batch=True)
    return _rounded(get_historical(entities(spark, sf_dir), REFERENCES[-1:], catalog))


@query
def feat_materialize(spark, sf_dir):
    view = _catalog(spark, sf_dir).view("driver_stats")
    return _rounded(materialize(view, START, END, spark)).withColumnRenamed("__found_at", "found_at")


@query
def feat_materialize_two_ranges(spark, sf_dir):
    """The later days first, then earlier ones that overlap with them."""
    view, path = _catalog(spark, sf_dir).view("driver_stats"), scratch_dir(spark, "snapshot")
    write_snapshot(view, MIDDLE, END, path, spark)
    write_snapshot(view, START, MIDDLE, path, spark)
    return _rounded(read_snapshot(view, path, spark)).withColumnRenamed("__found_at", "found_at")


@query
def feat_online_lookup(spark, sf_dir):
    catalog = _catalog(spark, sf_dir)
    path = scratch_dir(spark, "snapshot")
    write_snapshot(list(catalog.views.values()), START, END, path, spark)
    snapshots = dict.fromkeys(catalog.views, read_snapshot(list(catalog.views.values()), path, spark))
    rows = entities(spark, sf_dir).select("entity_id", F.col("driver_id").cast("long").alias("driver_id"))
    return _rounded(get_online(rows, REFERENCES, catalog, snapshots))
