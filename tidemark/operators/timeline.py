"""Per-customer event timeline: every time-range feature of the snapshot in
one shuffle-and-sort instead of the reference's per-feature theta joins.

Plan (a row is shuffled twice, whatever the number of features):

1. Each feed is rolled up by ``(customer_id, day)`` on its own (first shuffle).
   Partial aggregation runs map-side and the key spreads a customer holding a
   third of all rows over tasks by day.  An order also stands for its contract
   start and end days.  Invoices use fixed-width hash aggregation; the latest
   order of a day is a ``max`` over a struct, on the order branch alone.
2. One exchange on ``customer_id`` (the second and last) brings the rolled-up
   days of a customer together.  Behind it every invoice or order day emits a
   *probe* at its month start (the snapshot date t0), so probes are not shuffled;
   ``groupBy(customer_id, day)`` merges probes and feeds on that partitioning.  A customer is at most one row per calendar day,
   however many raw rows it has.  Feeds that a query does not use are not read.
3. One ``Window.partitionBy(customer_id)`` on the same partitioning with two
   orderings (day number, month index); Spark adds a sort between them but no
   exchange.  RANGE frames express the reference's
   ``t0 - N <= date < t0`` predicates exactly, because a probe sits at day
   ``t0`` and frames are relative to it:

   ================================  =====================  ==================
   reference predicate               frame (day)            features
   ================================  =====================  ==================
   ``date < t0`` latest (as-of)      (unbounded, -1)        recency, terms
   ``t0-180 <= date < t0``           (-180, -1)             rev_180d, mix
   ``t0-90 <= date < t0``            (-90, -1)              returns, counts
   ``t0-30 <= date < t0``            (-30, -1)              orders, backorders
   ``abs(date - t0) <= 30``          (-30, 30)              renewal grace
   ``t0 <= date < t0+90``            (0, 89)                forward revenue
   ================================  =====================  ==================

   Month frames use ``month = year*12 + month`` (t0 is always a month start,
   so whole-month windows are exact integer frames): gap statistics over the
   24-month lookback and the monthly revenue trends.

A sliding frame is added up again for every row.  Sums of integers are therefore
differences of two totals "up to offset", whose frames only grow: a row enters
each of them once.  Only sums of doubles (a difference would not be exact) and
percentiles keep sliding frames.

A task's memory is that of its customers' sorted days, so the exchange on
``customer_id`` has as many partitions as the input rows ask for (``TASK_ROWS``),
not a fixed number.
"""

from __future__ import annotations

import datetime
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.cadence import pay_term_cycle_days
from tidemark.params import CadenceParams

_DEC = "decimal(18,2)"
#: sums in cents that the snapshot's change ratios divide
CENTS = ("m_rev_3", "m_rev_prev_3", "m_rev_6", "m_rev_prev_6", "m_rev_ly", "m_rev_prev_month")
#: input rows (invoice and order lines) whose days one task sorts
TASK_ROWS = 250_000


def day_number(c: Column) -> Column:
    return F.unix_date(c)


def to_cents(amount: Column) -> Column:
    """decimal(18,2) -> exact integer cents.  Window sums over longs stay in
    fixed-width codegen; decimals above 18 digits would be BigDecimal objects
    (ANSI mode raises on overflow, it never wraps)."""
    return (amount * 100).cast("bigint")


def from_cents(cents: Column) -> Column:
    return (cents.cast("decimal(20,0)") * F.lit(Decimal("0.01"))).cast("decimal(38,2)")


def _known(df: DataFrame) -> DataFrame:
    """A NULL customer matches no spine row: it has no timeline."""
    return df.filter(F.col("customer_id").isNotNull())


def invoice_days(inv_signed: DataFrame) -> DataFrame:
    """Invoices by (customer_id, day); money in cents."""
    amt = to_cents(F.col("amt_local_signed"))
    return _known(inv_signed).groupBy("customer_id", day_number(F.col("tx_date")).alias("day")).agg(
        F.count(F.lit(1)).cast("int").alias("inv_n"),
        F.sum(amt).alias("inv_net"),
        F.sum(F.when(amt < 0, amt)).alias("inv_neg_amt"),
        F.sum(F.when(amt > 0, 1).otherwise(0)).alias("inv_pos_cnt"),
        F.sum(F.when(amt < 0, 1).otherwise(0)).alias("inv_neg_cnt"))


def order_days(orders_typed: DataFrame) -> DataFrame:
    """Orders and their contract dates by (customer_id, day).  ``ord_terms`` is
    the day's order with the highest order number (T8), its pay terms kept as
    they are, NULL included."""
    day, start, end = (day_number(F.col(c)) for c in ("order_date", "contract_start", "contract_end"))
    dates = F.array(F.struct(day.alias("day"), F.lit(1).alias("n")),
                    F.struct(start.alias("day"), F.lit(0).alias("n")),
                    F.struct(end.alias("day"), F.lit(0).alias("n")))
    is_order = F.col("at.n") == 1
    on = lambda c: F.when(is_order, c)
    return (
        _known(orders_typed).withColumn("at", F.explode(dates)).filter(F.col("at.day").isNotNull())
        .groupBy("customer_id", F.col("at.day").alias("day")).agg(
            F.max(on(F.lit(1))).alias("ord_n"),
            F.sum(on(to_cents(F.col("planned_revenue")))).alias("ord_rev"),
            F.sum(on(F.col("is_maint"))).alias("ord_maint"),
            F.sum(on(F.col("is_tech"))).alias("ord_tech"),
            F.max(on(F.struct("order_num", F.lower("pay_terms").alias("terms")))).alias("ord_terms"),
            F.max(F.when(~is_order, 1)).alias("contract")))


def backorder_days(backorders: DataFrame) -> DataFrame:
    return _known(backorders).filter(F.col("bo_date").isNotNull()).groupBy(
        "customer_id", day_number(F.col("bo_date")).alias("day")).agg(F.sum("qty").alias("bo_qty"))


def _with_probes(days: DataFrame, spine: Column, since: datetime.date | None) -> DataFrame:
    """Each day, and after it a probe at its month start where ``spine`` holds
    (and the month is not before ``since``)."""
    rest = [c for c in days.columns if c not in ("customer_id", "day")]
    itself = F.struct("day", F.lit(None).cast("int").alias("probe"), *rest)
    month = day_number(F.trunc(F.date_from_unix_date("day"), "MM"))
    types = dict(days.dtypes)
    probe = F.struct(month.alias("day"), F.lit(1).alias("probe"),
                     *[F.lit(None).cast(types[c]).alias(c) for c in rest])
    if since is not None:
        spine = spine & (month >= day_number(F.lit(since)))
    return days.select("customer_id", F.explode(F.when(spine, F.array(itself, probe)).otherwise(
        F.array(itself))).alias("e")).select("customer_id", "e.*")


def daily_rollup(inv_signed: DataFrame, orders_typed: DataFrame | None = None,
                 backorders: DataFrame | None = None, rows_in: int | None = None,
                 customers: DataFrame | None = None, since: datetime.date | None = None) -> DataFrame:
    """Steps 1-2: one row per (customer_id, day) over the given feeds.  ``rows_in``
    (rows of the raw tables) sets the number of tasks where it asks for more than
    ``spark.sql.shuffle.partitions``.  With ``customers`` only theirs, with
    ``since`` only probes of months from that one on."""
    rows = invoice_days(inv_signed)
    for days in (None if orders_typed is None else order_days(orders_typed),
                 None if backorders is None else backorder_days(backorders)):
        if days is not None:
            rows = rows.unionByName(days, allowMissingColumns=True)
    absent = {c: t for c, t in (("ord_n", "int"), ("ord_rev", "bigint"), ("ord_maint", "bigint"),
                                ("ord_tech", "bigint"), ("contract", "int"), ("bo_qty", "double"),
                                ("ord_terms", "struct<order_num:string,terms:string>"))
              if c not in rows.columns}
    rows = rows.withColumns({c: F.lit(None).cast(t) for c, t in absent.items()}) if absent else rows
    usual = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = -(-(rows_in or 0) // TASK_ROWS)
    dealt = lambda df: df.repartition(tasks, "customer_id") if tasks > usual else df.repartition("customer_id")
    near = dealt(rows)
    if customers is not None:
        # behind the exchange, where the rows need no other one for it (a semi join
        # would be moved below the roll-ups, an inner join is not)
        near = near.join(dealt(customers.distinct()).hint("shuffle_hash"), "customer_id")
    near = _with_probes(near, (F.col("inv_n") > 0) | (F.col("ord_n") == 1), since)
    merged = [c for c in near.columns if c not in ("customer_id", "day")]
    return (
        near.groupBy("customer_id", "day")
        .agg(*[F.max(c).alias(c) for c in merged])   # a feed has one row a day
        .withColumn("month", F.year(F.date_from_unix_date("day")) * 12
                    + F.month(F.date_from_unix_date("day")))
    )


def _month_of_day(c: Column) -> Column:
    d = F.date_from_unix_date(c)
    return F.year(d) * 12 + F.month(d)


def _totals(order, offsets: dict[str, tuple[int, ...]], counted: tuple[str, ...] = ()) -> list[Column]:
    """``c_to_<offset>``: the sum of ``c`` over all rows up to an offset after the
    row; ``c_known_to_<offset>``: how many of its values are there."""
    out = []
    for c, places in offsets.items():
        for at in places:
            frame = order.rangeBetween(Window.unboundedPreceding, at)
            out.append(F.sum(c).over(frame).alias(f"{c}_to_{at}"))
            if c in counted:
                out.append(F.count(c).over(frame).alias(f"{c}_known_to_{at}"))
    return out


def _between(c: str, lo: int, hi: int) -> Column:
    """The sum over ``lo .. hi`` from two totals; 0 where nothing is there."""
    total = lambda at: F.coalesce(F.col(f"{c}_to_{at}"), F.lit(0))
    return total(hi) - total(lo - 1)


def _known_between(c: str, lo: int, hi: int) -> Column:
    """The sum over ``lo .. hi``; NULL where no value is there, as SQL's sum."""
    return F.when(F.col(f"{c}_known_to_{hi}") > F.col(f"{c}_known_to_{lo - 1}"), _between(c, lo, hi))


def timeline_features(daily: DataFrame, params: CadenceParams = CadenceParams()) -> DataFrame:
    """Step 3: evaluate every frame; returns all timeline rows (probes and
    events) with the feature columns.  Use :func:`probe_features` for the
    (customer_id, t0) rows only."""
    by_cust = Window.partitionBy("customer_id")
    wd = by_cust.orderBy("day")
    wm = by_cust.orderBy("month")
    before = wd.rangeBetween(Window.unboundedPreceding, -1)
    g = params.grace_days

    is_inv = F.col("inv_n") > 0
    prev_inv = F.max(F.when(is_inv, F.col("day"))).over(before)
    terms = F.last(F.when(F.col("ord_n") == 1, F.struct("day", "ord_terms.terms")), True).over(before)
    last_contract = F.max(F.when(F.col("contract") == 1, F.col("day"))).over(
        wd.rangeBetween(Window.unboundedPreceding, g))
    day_level = daily.select(
        "*",
        prev_inv.alias("prev_inv_day"),
        terms.alias("last_order"),
        last_contract.alias("contract_day"),
        F.sum("bo_qty").over(wd.rangeBetween(-30, -1)).alias("w_bo_30"),
        *_totals(wd, {"inv_net": (-1, -181, 89), "inv_neg_amt": (-1, -91), "inv_pos_cnt": (-1, -91),
                      "inv_neg_cnt": (-1, -91), "ord_rev": (-1, -31), "ord_maint": (-1, -181),
                      "ord_tech": (-1, -181)}, counted=("ord_rev",)),
    ).select(
        *daily.columns, "prev_inv_day", "last_order", "w_bo_30",
        _between("inv_net", -180, -1).alias("w_rev_180"),
        _between("inv_neg_amt", -90, -1).alias("w_neg_90"),
        _between("inv_pos_cnt", -90, -1).alias("w_pos_90"),
        _between("inv_neg_cnt", -90, -1).alias("w_cn_90"),
        _known_between("ord_rev", -30, -1).alias("w_ord_30"),
        _between("ord_maint", -180, -1).alias("w_maint_180"),
        _between("ord_tech", -180, -1).alias("w_tech_180"),
        F.when(F.col("contract_day") >= F.col("day") - g, 1).alias("w_contract"),
        _between("inv_net", 0, 89).alias("w_fwd_90"),
        # gap to the previous distinct invoice day (never 0: days are distinct)
        F.when(is_inv, F.col("day") - F.col("prev_inv_day")).cast("bigint").alias("gap"),
        F.when(is_inv & (F.col("prev_inv_day").isNull()
                         | (_month_of_day(F.col("prev_inv_day")) < F.col("month"))), 1)
        .when(is_inv, 0).alias("first_inv_of_month"),
    ).withColumn("gap2", F.col("gap") * F.col("gap"))

    oldest = -params.lookback_months
    # month frames read invoice days and probes only: drop the other events
    # before the second sort
    month_level = day_level.filter((F.col("probe") == 1) | is_inv).select(
        "*",
        F.percentile("gap", F.array(F.lit(0.5), F.lit(0.9))).over(wm.rangeBetween(oldest, -1)).alias("gap_p"),
        *_totals(wm, {"gap": (-1, oldest - 1), "gap2": (-1, oldest - 1),
                      "inv_net": (-1, -2, -4, -7, -12, -13), "inv_neg_cnt": (-1, -2, -4),
                      "inv_pos_cnt": (-1, -2), "first_inv_of_month": (-1, -4)},
                 counted=("gap", "inv_net", "inv_neg_cnt")))
    gap_n = F.col("gap_known_to_-1") - F.col(f"gap_known_to_{oldest - 1}")
    # an invoice day has both counts, so one says whether the other is there
    invoiced = F.col("inv_neg_cnt_known_to_-1") > F.col("inv_neg_cnt_known_to_-2")
    return month_level.select(
        *day_level.columns,
        gap_n.alias("gap_n"),
        F.when(gap_n > 0, _between("gap", oldest, -1)).alias("gap_sum"),
        F.when(gap_n > 0, _between("gap2", oldest, -1)).alias("gap_sum2"),
        F.get("gap_p", F.lit(0)).alias("gap_p50"),
        F.get("gap_p", F.lit(1)).alias("gap_p90"),
        _known_between("inv_net", -3, -1).alias("m_rev_3"),
        _known_between("inv_net", -6, -4).alias("m_rev_prev_3"),
        _known_between("inv_net", -6, -1).alias("m_rev_6"),
        _known_between("inv_net", -12, -7).alias("m_rev_prev_6"),
        _known_between("inv_net", -12, -12).alias("m_rev_ly"),
        _known_between("inv_net", -1, -1).alias("m_rev_prev_month"),
        F.when(invoiced, _between("inv_neg_cnt", -1, -1)).alias("m_cn_prev_month"),
        F.when(invoiced, _between("inv_pos_cnt", -1, -1)).alias("m_ip_prev_month"),
        _known_between("inv_neg_cnt", -3, -1).alias("m_cn_3"),
        _between("first_inv_of_month", -3, -1).alias("m_months_3"),
    )


def probe_features(timeline: DataFrame) -> DataFrame:
    """The spine rows (customer_id, t0) with their raw timeline features."""
    dec = lambda c: c.cast(_DEC)
    cents = lambda name: from_cents(F.col(name))
    return (
        timeline.filter(F.col("probe") == 1)
        .select(
            "customer_id",
            F.date_from_unix_date("day").alias("t0"),
            F.date_from_unix_date("prev_inv_day").alias("last_tx_date"),
            (F.col("day") - F.col("prev_inv_day")).alias("recency_days"),
            dec(F.coalesce(cents("w_rev_180"), F.lit(0))).alias("rev_180d"),
            dec(F.coalesce(F.abs(cents("w_neg_90")), F.lit(0))).alias("rev_returns_90d"),
            F.coalesce(F.col("w_pos_90"), F.lit(0)).cast("bigint").alias("invoices_90d"),
            F.coalesce(F.col("w_cn_90"), F.lit(0)).cast("bigint").alias("credit_notes_90d"),
            cents("w_ord_30").alias("orders_net_30d"),
            F.coalesce(F.col("w_bo_30"), F.lit(0.0)).alias("backorder_qty_30d"),
            F.coalesce(F.col("w_maint_180"), F.lit(0)).cast("int").alias("maint_orders_180d"),
            F.coalesce(F.col("w_tech_180"), F.lit(0)).cast("int").alias("tech_orders_180d"),
            F.date_from_unix_date("last_order.day").alias("last_order_date"),
            F.col("last_order.terms").alias("pay_terms"),
            pay_term_cycle_days(F.col("last_order.terms")).alias("terms_cycle_days"),
            F.coalesce(F.col("w_contract"), F.lit(0)).cast("int").alias("in_renewal_grace"),
            dec(F.coalesce(cents("w_fwd_90"), F.lit(0))).alias("forward_rev_90d"),
            "gap_n", "gap_sum", "gap_sum2", "gap_p50", "gap_p90",
            cents("m_rev_3").alias("rev_trailing_3m"),
            cents("m_rev_prev_3").alias("rev_trailing_prev_3m"),
            cents("m_rev_6").alias("rev_trailing_6m"),
            cents("m_rev_prev_6").alias("rev_trailing_prev_6m"),
            cents("m_rev_ly").alias("rev_same_month_ly"),
            cents("m_rev_prev_month").alias("rev_prev_month"),
            *[F.col(c) for c in CENTS],
            F.col("m_cn_prev_month").cast("int").alias("credit_notes_prev_month"),
            F.col("m_ip_prev_month").cast("int").alias("invoices_pos_prev_month"),
            # mean over the months present in the window (no zero fill)
            F.try_divide(F.col("m_cn_3").cast("double"), F.col("m_months_3").cast("double"))
            .alias("credit_notes_ma3"),
        )
    )


def invoice_gap_rows(timeline: DataFrame) -> DataFrame:
    """Each distinct invoice day with the previous one and the gap."""
    return (
        timeline.filter(F.col("inv_n") > 0)
        .select("customer_id",
                F.date_from_unix_date("day").alias("tx_day"),
                F.date_from_unix_date("prev_inv_day").alias("prev_tx_day"),
                F.col("gap").cast("int").alias("gap_days"))
    )
