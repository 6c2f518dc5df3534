"""Row counts after each step at three scales; a reordered plan misses them."""

import pytest
from pyspark.sql import functions as F

from ledgersift.operators import checks, dedupe, sigma
from ledgersift.plans import clean as cleaning
from ledgersift.workload.queries import QUERIES
from ledgersift.workload.tables import driver_stats, entities, tx_raw

SCALES = ["sf0.001", "sf0.01", "sf0.1"]
SIGMA_FIRST = {
    "sf0.001": [1091, 1076, 1057, 989, 946, 922, 889],
    "sf0.01": [10890, 10774, 10577, 9896, 9430, 9393, 9373],
    "sf0.1": [108894, 107770, 105791, 98969, 94317, 94212, 94200],
}
CUSTOMER_FIRST = {
    "sf0.001": [1091, 1076, 1057, 989, 946, 889, 875],
    "sf0.01": [10890, 10774, 10577, 9896, 9430, 9373, 9201],
    "sf0.1": [108894, 107770, 105791, 98969, 94317, 94247, 92553],
}
AMOUNTS = {
    "sf0.001": (44609.39, 41190.94),
    "sf0.01": (465654.16, 423415.46),
    "sf0.1": (4674314.89, 4273882.24),
}


@pytest.mark.parametrize("sf_name", SCALES)
@pytest.mark.parametrize("which", ["a", "b"])
def test_steps(spark, sf, sf_name, which):
    order = cleaning.SIGMA_FIRST if which == "a" else cleaning.CUSTOMER_FIRST
    expected = (SIGMA_FIRST if which == "a" else CUSTOMER_FIRST)[sf_name]
    raw = tx_raw(spark, sf[sf_name])
    report = cleaning.clean_report(raw, order).orderBy("step_no").collect()
    assert [r.rows_out for r in report] == expected
    assert report[0].removed_share == 0
    assert report[-1].removed_share == pytest.approx(1 - expected[-1] / expected[0])

    rows, amount = cleaning.clean(raw, order).agg(F.count(F.lit(1)), F.sum("tx_amount")).first()
    assert rows == expected[-1]
    assert amount == pytest.approx(AMOUNTS[sf_name][which == "b"], abs=0.01)


def test_filtering_before_deduplication_keeps_more(spark, sf):
    raw = cleaning.drop_incomplete(tx_raw(spark, sf["sf0.01"])).filter("tx_amount > 0")
    assert cleaning.one_per_transaction(raw).count() == 9671


@pytest.mark.parametrize(
    "sf_name, expected",
    [
        ("sf0.001", (15, 20, 88, 38, 9, 64, 9)),
        ("sf0.01", (116, 200, 861, 363, 123, 406, 85)),
        ("sf0.1", (1124, 2000, 8602, 3612, 1248, 3734, 870)),
    ],
)
def test_checks(spark, sf, sf_name, expected):
    raw = tx_raw(spark, sf[sf_name])
    duplicates = dedupe.duplicate_counts(raw, "transaction_id").first()
    counted = checks.count_checks(raw, checks.standard_checks()).first()
    assert (
        raw.filter("terminal_id IS NULL").count(),
        duplicates.surplus_rows,
        duplicates.repeated_keys,
        counted.negative_amount,
        counted.zero_amount,
        sigma.sigma_summary(raw, "tx_amount").first().outliers,
        counted.scenario_without_fraud,
    ) == expected
    assert raw.transform(checks.with_clock_skew).select("seconds_diff").distinct().count() == 6


@pytest.mark.parametrize(
    "sf_name, rows, drivers, asked, matched, conv, score",
    [
        ("sf0.001", 397, 15, 202, 181, 30.1357, 200.9133),
        ("sf0.01", 4006, 150, 1981, 1776, 361.6619, 2176.2968),
        ("sf0.1", 40083, 1500, 20084, 18241, 3656.2179, 22131.5733),
    ],
)
def test_features(spark, sf, sf_name, rows, drivers, asked, matched, conv, score):
    folder = sf[sf_name]
    known = driver_stats(spark, folder)
    assert known.count() == known.select("driver_id", "event_timestamp").distinct().count() == rows
    assert known.select("driver_id").distinct().count() == drivers
    assert entities(spark, folder).count() == asked
    found = QUERIES["feat_historical_ttl"](spark, folder).agg(
        F.count("driver_stats__conv_rate"), F.sum("driver_stats__conv_rate")
    )
    assert found.first()[0] == matched
    assert found.first()[1] == pytest.approx(conv, abs=1e-3)
    total = QUERIES["feat_activity_score"](spark, folder).agg(F.sum("activity_score__activity_score"))
    assert total.first()[0] == pytest.approx(score, abs=1e-2)
