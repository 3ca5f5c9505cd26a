"""Derived business columns of the snapshot as Column
expressions.  Every division is NULL-guarded (Spark runs in ANSI mode, where
``x / 0`` raises)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.params import CadenceParams

DECLINE = -0.30  # a 3m / 6m / yoy change at or below this is a spend decline

# Pay-term keyword -> billing cycle in days.  First matching
# row wins, keywords are matched as substrings of the lower-cased terms.
PAY_TERM_CYCLES: list[tuple[tuple[str, ...], int]] = [
    (("month", "30"), 30),
    (("quarter", "qtr", "90"), 90),
    (("annual", "year", "360", "365"), 365),
    (("upfront", "prepay"), 9999),
]


def pay_term_cycle_days(pt: Column) -> Column:
    """cycle length from lower-cased pay terms; NULL when no keyword
    occurs in them (or the terms are NULL)."""
    expr = F
    for words, days in PAY_TERM_CYCLES:
        hit = reduce(lambda a, b: a | b, [pt.contains(w) for w in words])
        expr = expr.when(hit, F.lit(days))
    return expr


def maint_cycle_days(terms_cycle: Column, median_gap_days_int: Column) -> Column:
    """pay-term cycle of the latest order before t0, else the
    (truncated) median purchase gap."""
    return F.coalesce(terms_cycle, median_gap_days_int).cast("int")


def is_maintenance_heavy(maint_180: Column, tech_180: Column) -> Column:
    """F3."""
    return F.when((maint_180 >= tech_180) & (maint_180 > 0), 1).otherwise(0)


def threshold_days(cycle: Column, p90_raw: Column, median_raw: Column, grace: Column,
                   params: CadenceParams = CadenceParams()) -> Column:
    """expected-purchase threshold.  With a cycle: round(1.2 * cycle);
    otherwise max(p90, K * median) with single-sided fallbacks.  Renewal grace
    adds ``grace_days``; the result is floored at ``min_threshold_days`` and
    stored as an int (truncation, as the reference's int column does)."""
    k = F.lit(float(params.k_mult))
    km = k * median_raw
    from_gaps = (
        F.when(p90_raw.isNotNull() & median_raw.isNotNull(),
               F.when(p90_raw > km, p90_raw).otherwise(km))
        .when(p90_raw.isNotNull(), p90_raw)
        .when(median_raw.isNotNull(), km)
    )
    base = F.when(cycle.isNotNull(), F.round(F.lit(1.2) * cycle.cast("double"), 0)).otherwise(from_gaps)
    raw = base + F.when(grace == 1, F.lit(params.grace_days)).otherwise(F.lit(0))
    floor = F.lit(params.min_threshold_days)
    return F.when(raw < floor, floor).otherwise(raw).cast("int")


#: cents up to which a difference times 10^6 is a 64-bit integer
SMALL_CENTS = 4_600_000_000_000


def cents_ratio(cur: Column, prev: Column) -> Column:
    """``(cur - prev) / prev`` of whole cents as the source's decimal division
    gives it: six decimals, the rest cut off, then stored as a float.  Exact: in
    64-bit integers, or in decimals where these would overflow.  The caller
    guards against a zero ``prev``."""
    small = cur.between(-SMALL_CENTS, SMALL_CENTS) & prev.between(-SMALL_CENTS, SMALL_CENTS)
    quick = F.call_function("div", (cur - prev) * F.lit(1_000_000).cast("bigint"), prev)
    wide = lambda c: c.cast("decimal(20,0)")
    a, b = ((wide(cur) - wide(prev)) * F.lit(1_000_000)).cast("decimal(38,0)"), wide(prev)
    # a - a % b is a multiple of b and % has the sign of a: division towards zero
    exact = ((a - a % b) / b).cast("decimal(38,0)")
    return F.when(small, quick.cast("double")).otherwise(exact.cast("double")) / F.lit(1e6)


def change_ratio(cur: Column, prev: Column) -> Column:
    """(cur - prev) / prev of cents as a fraction; NULL when prev is 0 or NULL."""
    return F.when(cur.isNotNull() & (prev != 0), cents_ratio(cur, prev))


def yoy_change(prev_month: Column, same_month_ly: Column) -> Column:
    """month t0-1 against month t0-12 (the reference's off-by-one kept), in cents."""
    return F.when(same_month_ly != 0,
                  cents_ratio(F.coalesce(prev_month, F.lit(0).cast("bigint")), same_month_ly))


def churned_hard90(forward_rev_90d: Column) -> Column:
    """churned unless the *net* forward 90-day revenue is positive."""
    return F.when(forward_rev_90d > 0, 0).otherwise(1)


def churned_dynamic(recency: Column, threshold: Column) -> Column:
    """F8: late against the customer's own cadence (strictly greater)."""
    return F.when(recency > threshold, 1).otherwise(0)


def _declines(p3: Column, p6: Column, yoy: Column) -> tuple[Column, Column, Column]:
    d = F.lit(DECLINE)
    return (F.coalesce(p3, F.lit(0.0)) <= d,
            F.coalesce(p6, F.lit(0.0)) <= d,
            F.coalesce(yoy, F.lit(0.0)) <= d)


def _decline_codes(p3: Column, p6: Column, yoy: Column) -> Column:
    d3, d6, dy = _declines(p3, p6, yoy)
    return F.concat_ws("|", F.when(d3, F.lit("3M_DROP")), F.when(d6, F.lit("6M_DROP")),
                       F.when(dy, F.lit("YOY_DROP")))


def _any_decline(p3: Column, p6: Column, yoy: Column) -> Column:
    d3, d6, dy = _declines(p3, p6, yoy)
    return d3 | d6 | dy


def sql_float_text(x: Column) -> Column:
    """Text of a float the way the source database's default float-to-text
    conversion writes it: at most 6 significant digits, no trailing zeros,
    scientific notation with a 3-digit exponent outside [1e-4, 1e6)."""
    g = F.format_string("%.6g", x.cast("double"))
    # split mantissa / exponent, strip trailing zeros of the mantissa
    mant = F.regexp_extract(g, r"^([^e]*)", 1)
    expo = F.regexp_extract(g, r"(e[+-]\d+)$", 1)
    mant = F.regexp_replace(F.regexp_replace(mant, r"(\.\d*?)0+$", "$1"), r"\.$", "")
    expo3 = F.regexp_replace(expo, r"^e([+-])(\d)(\d)$", "e$10$2$3")
    return F.when(x.isNull(), F.lit(None)).otherwise(F.concat(mant, expo3))


def reason_dynamic(recency: Column, threshold: Column, grace: Column, invoices_90d: Column,
                   returns_90d: Column, orders_pos_30d: Column, backorder_qty_30d: Column,
                   p3: Column, p6: Column, yoy: Column) -> Column:
    """human-readable reason for churned_dynamic = 1, else NULL."""
    parts = F.concat(
        F.lit("Late vs cadence: recency "), recency.cast("string"),
        F.lit("d > threshold "), threshold.cast("string"), F.lit("d"),
        F.when(grace == 1, F.lit(" (within renewal grace window)")).otherwise(F.lit("")),
        F.when(invoices_90d == 0, F.lit("; 0 invoices in prior 90d")).otherwise(F.lit("")),
        F.when(returns_90d > 0, F.concat(F.lit("; returns_90d="), returns_90d.cast("string")))
        .otherwise(F.lit("")),
        F.when(F.coalesce(orders_pos_30d, F.lit(0)) == 0, F.lit("; no orders in prior 30d"))
        .otherwise(F.lit("")),
        F.when(F.coalesce(backorder_qty_30d, F.lit(0.0)) > 0,
               F.concat(F.lit("; backorders_30d="), sql_float_text(backorder_qty_30d)))
        .otherwise(F.lit("")),
        F.when(_any_decline(p3, p6, yoy),
               F.concat(F.lit("; spend decline: "), _decline_codes(p3, p6, yoy)))
        .otherwise(F.lit("")),
    )
    return F.when(recency > threshold, parts)


def reason_code_dynamic(recency: Column, threshold: Column, grace: Column, invoices_90d: Column,
                        returns_90d: Column, orders_pos_30d: Column, backorder_qty_30d: Column,
                        p3: Column, p6: Column, yoy: Column) -> Column:
    """the same conditions as pipe-joined codes."""
    parts = F.concat(
        F.lit("RECENCY_GT_"), threshold.cast("string"), F.lit("D"),
        F.when(grace == 1, F.lit("|RENEWAL_GRACE")).otherwise(F.lit("")),
        F.when(invoices_90d == 0, F.lit("|NO_INV_90D")).otherwise(F.lit("")),
        F.when(returns_90d > 0, F.lit("|RETURNS_90D")).otherwise(F.lit("")),
        F.when(F.coalesce(orders_pos_30d, F.lit(0)) == 0, F.lit("|NO_ORDERS_30D")).otherwise(F.lit("")),
        F.when(F.coalesce(backorder_qty_30d, F.lit(0.0)) > 0, F.lit("|BACKORDERS_30D")).otherwise(F.lit("")),
        F.when(_any_decline(p3, p6, yoy),
               F.concat(F.lit("|SPEND_DOWN("), _decline_codes(p3, p6, yoy), F.lit(")")))
        .otherwise(F.lit("")),
    )
    return F.when(recency > threshold, parts)


# Fixed value: the reason text of the hard 90-day label.
HARD90_REASON = "No positive posted revenue in the 90 days after t0"


def reason_hard90(hard90: Column) -> Column:
    """F11."""
    return F.when(hard90 == 1, F.lit(HARD90_REASON))


def _clamp01(x: Column) -> Column:
    # NULL stays NULL (greatest/least would skip it)
    return F.when(x < 0, F.lit(0.0)).when(x > 1, F.lit(1.0)).otherwise(x)


def lateness_component(recency: Column, threshold: Column) -> Column:
    """logistic lateness, 1 / (1 + exp(-4 (recency - thr) / thr)); the
    threshold is a float in the source, so the ratio is float arithmetic."""
    ratio = F.when(threshold != 0, (recency - threshold).cast("double") / threshold.cast("double"))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-4.0) * ratio))


def credits_component(returns_90d: Column, rev_180d: Column) -> Column:
    """returns over |revenue|, clamped to [0, 1]; 0 without revenue."""
    denom = F.abs(rev_180d).cast("double")
    return F.when(denom == 0, F.lit(0.0)).otherwise(_clamp01(returns_90d.cast("double") / denom))


def trend_component(p3: Column, p6: Column, yoy: Column) -> Column:
    """0.4 per 3m / 6m decline, 0.3 for yoy (summed in tenths so that
    1.1 is the same float as the reference's exact decimal sum)."""
    d3, d6, dy = _declines(p3, p6, yoy)
    tenths = (F.when(d3, 4).otherwise(0) + F.when(d6, 4).otherwise(0) + F.when(dy, 3).otherwise(0))
    return tenths.cast("double") / F.lit(10.0)


def mitigator_component(orders_pos_30d: Column, grace: Column) -> Column:
    """0.5 for recent positive orders, 0.5 for renewal grace."""
    tenths = (F.when(F.coalesce(orders_pos_30d, F.lit(0)) > 0, 5).otherwise(0)
              + F.when(grace == 1, 5).otherwise(0))
    return tenths.cast("double") / F.lit(10.0)


def severity_score(late: Column, credits: Column, trend: Column, mitig: Column) -> Column:
    """F16: 100 * clamp(.6 L + .2 C + .2 T - .15 M, 0, 1)."""
    raw = F.lit(0.6) * late + F.lit(0.2) * credits + F.lit(0.2) * trend - F.lit(0.15) * mitig
    return F.lit(100.0) * _clamp01(raw)
