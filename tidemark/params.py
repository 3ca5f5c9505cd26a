"""Run parameters.  Defaults are the reference job's defaults."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class CadenceParams:
    """Parameters of the snapshot build."""

    lookback_months: int = 24          # purchase-gap history window
    min_threshold_days: int = 14       # floor of threshold_days
    k_mult: float = 2.0                # multiplier on the median gap (fallback branch)
    grace_days: int = 30               # renewal window half-width and days added
    org_codes: tuple[str, ...] = ("US01",)
    # Order intake keeps lines whose reject code is blank; the backorder feed
    # keeps the lines whose reject code is *not* blank.  Both are what the
    # reference job does, kept as switches.
    orders_keep_rejected: bool = False
    backorders_keep_rejected: bool = True


@dataclass(frozen=True)
class ScoreParams:
    """Parameters of the scoring and report stage."""

    target_col: str = "churned_hard90"
    as_of: str | None = None           # keep only snapshots with this yyyy-mm-dd date
    keep_all_rows: bool = False        # False: latest snapshot per customer
    top: int | None = None             # TOP n rows before filtering (n > 0 only)
    decision_cut: float = 0.5          # probability >= cut -> predicted churn
    business_days: int = 90            # "churned now" base threshold
    business_grace_days: int = 30      # added when in renewal grace
    headers: str = "friendly"          # "friendly" or "technical"
    max_iter: int = 1000
    tol: float = 1e-8
    solver: str = "lbfgs"              # "lbfgs" or "newton" (exact to rounding)
    background_rows: int = 0           # > 0: contributions relative to a sample of so many rows
    median_accuracy: int = 10000       # sketch accuracy that brackets the exact median
    feature_cols: tuple[str, ...] = field(default_factory=lambda: tuple(FEATURE_COLUMNS))


# The 26 model features, in the reference's order.  The order
# breaks ties between equal contributions, so it must not change.
FEATURE_COLUMNS = [
    "recency_days",
    "median_gap_days",
    "p90_gap_days",
    "cv_gap",
    "in_renewal_grace",
    "rev_180d",
    "rev_returns_90d",
    "invoices_90d",
    "credit_notes_90d",
    "orders_pos_30d",
    "orders_neg_30d",
    "backorder_qty_30d",
    "pct_change_3m",
    "pct_change_6m",
    "yoy_change_pct",
    "credit_notes_prev_month",
    "invoices_pos_prev_month",
    "credit_notes_ma3",
    "threshold_days",
    "is_maintenance_heavy",
    "maint_cycle_days",
    "severity_score",
    "lateness_component",
    "credits_component",
    "trend_component",
    "mitigator_component",
]

CUSTOMER_ID_COL = "customer_id"
DATE_COL = "as_of_date"
