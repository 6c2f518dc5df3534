"""The cleaning plan: drop incomplete rows, one row per transaction, range
filters, three-sigma trim. The two orders give different answers, since
the trim takes its statistics from the rows that are left at that point."""

from __future__ import annotations

from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, functions as F

from ..functions.columns import all_present, quoted
from ..operators.checks import positive
from ..operators.dedupe import COPIES, copies, dedupe_by_key
from ..operators.sigma import bounds, sigma_trim

KEY = "transaction_id"
TIME = "tx_datetime"
AMOUNT = "tx_amount"
CUSTOMER = "customer_id"

# The two orders of the last three steps.
SIGMA_FIRST = ("amount", "sigma", "customer")
CUSTOMER_FIRST = ("amount", "customer", "sigma")


def drop_incomplete(df: DataFrame) -> DataFrame:
    """Rows without any NULL or NaN."""
    return df.dropna("any")


def one_per_transaction(df: DataFrame) -> DataFrame:
    return dedupe_by_key(df, [KEY], [TIME])


def clean(df: DataFrame, order: Sequence[str] = SIGMA_FIRST, k: float = 3.0) -> DataFrame:
    """The cleaned table.

    Full copies need no step of their own: they share the transaction, of
    which one row stays. The filters follow the deduplication and cannot
    go before it, as a transaction whose first row is bad leaves as a whole.
    """
    _known(order, ("amount", "customer", "sigma"))
    out = one_per_transaction(drop_incomplete(df))
    for step in order:
        out = _step(out, step, k)
    return out


class StepCounts:
    """Rows left after each step, counted while the cleaned table is written.

    To be read after an action on the table. Without rows to count Spark may
    drop the counting with the rest of the plan: no count is 0 then.
    """

    def __init__(self):
        self._seen: list[tuple[str, Observation]] = []

    def after(self, step: str, df: DataFrame, **also: Column) -> DataFrame:
        seen = Observation()
        self._seen.append((step, seen))
        return df.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in also.items()])

    def get(self, step: str, name: str = "rows") -> int:
        try:
            return int(dict(self._seen)[step].get[name] or 0)
        except Py4JJavaError:  # an observation that was dropped has no schema to read it by
            return 0

    def lines(self) -> list[tuple[int, str, int, float | None]]:
        """As ``clean_report`` has them: number, step, rows, share removed."""
        counts = [(step, self.get(step)) for step, _ in self._seen]
        total = counts[0][1]
        return [(i, step, n, 1 - n / total if total else None) for i, (step, n) in enumerate(counts)]


def clean_counted(
    df: DataFrame, order: Sequence[str] = SIGMA_FIRST, k: float = 3.0, full: bool = False, **also: Column
) -> tuple[DataFrame, StepCounts]:
    """The cleaned table as ``clean`` gives it, and counts that whatever writes
    it makes on its way: no pass of their own. ``also`` are further aggregates
    over the input, whose columns they may use although they are not cleaned.

    ``full`` counts full copies as a step of its own. They then leave before the
    rows of a transaction meet, which takes one more shuffle, though no other
    read of the input.
    """
    _known(order, ("amount", "customer", "sigma"))
    counts = StepCounts()
    out = counts.after("input", df, **also).select(*[quoted(c) for c in df.columns if c not in also])
    out = counts.after("dropna", drop_incomplete(out))
    if full:
        out = counts.after("dedup_full", out.dropDuplicates())
    out = counts.after("dedup_key", one_per_transaction(out))
    for step in order:
        out = counts.after(step, _step(out, step, k))
    return out, counts


def _step(df: DataFrame, step: str, k: float) -> DataFrame:
    if step == "sigma":
        return sigma_trim(df, AMOUNT, k)
    return df.filter(positive(AMOUNT if step == "amount" else CUSTOMER))


def clean_report(df: DataFrame, order: Sequence[str] = SIGMA_FIRST, k: float = 3.0) -> DataFrame:
    """Rows left after each step: ``step_no``, ``step``, ``rows_out``, ``removed_share``.

    All counts come from one scan: distinct rows are counted first, then
    brought together per transaction, of which the first row goes through
    the filters as flags.
    """
    _known(order, ("amount", "customer", "sigma"))
    rest = [c for c in df.columns if c not in (KEY, TIME)]
    complete = all_present(df)
    first = F.struct(*[quoted(c) for c in [TIME, *rest]])
    per_key = (
        copies(df)
        .groupBy(KEY)
        .agg(
            F.sum(COPIES).alias("n_input"),
            F.sum(F.when(complete, F.col(COPIES)).otherwise(0)).alias("n_complete"),
            F.count_if(complete).alias("n_distinct"),
            F.min(F.when(complete, first)).alias("first"),
        )
        .select(
            "n_input",
            "n_complete",
            "n_distinct",
            F.col("first").isNotNull().alias("kept"),
            F.col(f"first.{AMOUNT}").alias(AMOUNT),
            F.col(f"first.{CUSTOMER}").alias(CUSTOMER),
        )
    )

    kept: Column = F.col("kept")
    counts = [
        ("input", F.sum("n_input")),
        ("dropna", F.sum("n_complete")),
        ("dedup_full", F.sum("n_distinct")),
        ("dedup_key", F.count_if(kept)),
    ]
    for step in order:
        if step == "sigma":
            # The totals are asked for here too, although only the bounds are
            # read: with the same columns on both sides Spark shares the
            # shuffled counts between them.
            amounts = bounds(F.when(kept, F.col(AMOUNT)), k)
            totals = [F.sum(n) for n in ("n_input", "n_complete", "n_distinct")]
            stats = per_key.agg(F.struct(amounts.alias("b"), *totals).alias("s")).scalar()["b"]
            inside = F.col(AMOUNT).between(stats["lower"], stats["upper"])
            kept = kept & (stats["upper"].isNull() | inside)
        else:
            kept = kept & positive(AMOUNT if step == "amount" else CUSTOMER)
        counts.append((step, F.count_if(kept)))

    one = per_key.agg(*[F.coalesce(count, F.lit(0)).alias(name) for name, count in counts])
    lines = [
        F.struct(
            F.lit(i).alias("step_no"),
            F.lit(name).alias("step"),
            F.col(name).alias("rows_out"),
            (1 - F.try_divide(F.col(name), F.col("input"))).alias("removed_share"),
        )
        for i, (name, _) in enumerate(counts)
    ]
    return one.select(F.inline(F.array(*lines)))


def _known(order: Sequence[str], steps) -> None:
    unknown = [s for s in order if s not in steps]
    if unknown:
        raise ValueError(f"unknown cleaning steps: {unknown}")
