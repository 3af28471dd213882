"""Column expressions (scalar functions). All are built-in Spark expressions,
so they stay inside whole-stage code generation.

Several metrics exist in more than one variant with different edge-case
semantics; each variant is a separate, explicitly named function.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400_000_000

# Size-tier boundaries and labels.
TIER_BOUNDS = [10_000, 100_000, 1_000_000, 10_000_000]
TIER_LABELS_SQL = ["Nano (<10K)", "Micro (10K-100K)", "Mid (100K-1M)", "Macro (1M-10M)", "Mega (10M+)"]
TIER_LABELS = ["Nano", "Micro", "Mid", "Macro", "Mega"]


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# P1 / P2 ---------------------------------------------------------------------
def engagement_rate(likes="likes", comments="comment_count", views="views") -> Column:
    """(likes + comments) / views, NULL when views is 0."""
    return F.try_divide((_c(likes) + _c(comments)).cast("double"), F.nullif(_c(views), F.lit(0)))


def engagement_rate_or_zero(likes="likes", comments="comment_count", views="views") -> Column:
    """(likes + comments) / views, 0 when views is not positive."""
    return F.when(_c(views) > 0, (_c(likes) + _c(comments)) / _c(views)).otherwise(F.lit(0.0))


def engagement_rate_positive_only(likes="likes", comments="comment_count", views="views") -> Column:
    """SQL view variant: NULL unless views > 0 (used inside AVG)."""
    return F.when(_c(views) > 0, (_c(likes) + _c(comments)).cast("double") / _c(views))


# P3 / P4 ---------------------------------------------------------------------
def slug(c) -> Column:
    """lower-case, every run of non-word characters -> '_' (Unicode aware)."""
    return F.regexp_replace(F.lower(_c(c)), r"(?U)\W+", "_")


def years_active(created_year="created_year", as_of_year: int = 2024) -> Column:
    return F.greatest(F.lit(as_of_year) - F.coalesce(_c(created_year), F.lit(as_of_year - 3)), F.lit(1))


def weekly_uploads(total_videos="total_videos", created_year="created_year", as_of_year: int = 2024) -> Column:
    return _c(total_videos) / (years_active(created_year, as_of_year) * F.lit(52.0))


# P5 / P6 ---------------------------------------------------------------------
def parse_timestamp(c, fmt: str | None = None) -> Column:
    """Unparseable text -> NULL."""
    return F.try_to_timestamp(_c(c), F.lit(fmt)) if fmt else F.try_to_timestamp(_c(c))


# P7 / P8 ---------------------------------------------------------------------
def size_tier_sql(size="subscribers") -> Column:
    """Left-closed CASE chain; NULL size falls through to the last tier."""
    s = _c(size)
    e = F.when(s < TIER_BOUNDS[0], TIER_LABELS_SQL[0])
    for b, lab in zip(TIER_BOUNDS[1:], TIER_LABELS_SQL[1:]):
        e = e.when(s < b, lab)
    return e.otherwise(TIER_LABELS_SQL[-1])


def size_tier(size="subscribers") -> Column:
    """Right-closed bins (0,1e4] (1e4,1e5] ... (1e7,inf); size <= 0 or NULL -> NULL."""
    s = _c(size)
    e = F.when(s.isNull() | (s <= 0), F.lit(None).cast("string"))
    for b, lab in zip(TIER_BOUNDS, TIER_LABELS):
        e = e.when(s <= b, lab)
    return e.otherwise(TIER_LABELS[-1])


def size_tier_ordinal(size="subscribers") -> Column:
    s = _c(size)
    e = F.when(s.isNull() | (s <= 0), F.lit(None).cast("int"))
    for i, b in enumerate(TIER_BOUNDS):
        e = e.when(s <= b, F.lit(i))
    return e.otherwise(F.lit(len(TIER_BOUNDS)))


# P10 / P11 -------------------------------------------------------------------
def consistency_null_on_zero(std) -> Column:
    """1/std; std 0 -> NULL."""
    return F.try_divide(F.lit(1.0), F.nullif(_c(std), F.lit(0.0)))


def consistency_floor(std) -> Column:
    """1/std with std 0 or NULL replaced by 0.01 (score 100)."""
    return F.lit(1.0) / F.coalesce(F.nullif(_c(std), F.lit(0.0)), F.lit(0.01))


def consistency_positive(std) -> Column:
    """CASE WHEN std > 0 THEN 1/std END."""
    return F.when(_c(std) > 0, F.lit(1.0) / _c(std))


def safe_ratio(num, den) -> Column:
    """num / den, NULL unless den > 0."""
    return F.when(_c(den) > 0, _c(num).cast("double") / _c(den))


# P12 / P13 / P14 -------------------------------------------------------------
def weekday_monday0(ts) -> Column:
    return F.weekday(_c(ts))


def cohort_label(ts, freq: str = "Q") -> Column:
    """'2023Q1' for quarters, '2023' for years (pandas Period string)."""
    if freq.upper().startswith("Q"):
        return F.concat(F.year(_c(ts)).cast("string"), F.lit("Q"), F.quarter(_c(ts)).cast("string"))
    if freq.upper().startswith(("Y", "A")):
        return F.year(_c(ts)).cast("string")
    if freq.upper().startswith("M"):
        return F.date_format(_c(ts), "yyyy-MM")
    raise ValueError(f"unsupported cohort frequency {freq}")


def text_length(c) -> Column:
    return F.length(F.coalesce(_c(c), F.lit("")))


# P15 / P16 / P17 -------------------------------------------------------------
def epoch_micros(ts) -> Column:
    """Microseconds since 1970 for TIMESTAMP or TIMESTAMP_NTZ (session TZ is UTC)."""
    return F.unix_micros(_c(ts).cast("timestamp"))


def whole_days(start, end) -> Column:
    """Floor of (end - start) in days, like Timedelta.days."""
    return F.floor((epoch_micros(end) - epoch_micros(start)) / F.lit(MICROS_PER_DAY)).cast("long")


def fractional_days(start, end) -> Column:
    return (epoch_micros(end) - epoch_micros(start)) / F.lit(float(MICROS_PER_DAY))


def plus_days(ts, days: int) -> Column:
    return _c(ts) + F.make_dt_interval(F.lit(days))


# P24 / P25 / P27 -------------------------------------------------------------
def performer_label(z) -> Column:
    return F.when(_c(z) > 2, "over-performer").when(_c(z) < -2, "under-performer").otherwise("normal")


def concentration_label(hhi) -> Column:
    """HHI above 2 500 reads as concentrated, anything else as diverse."""
    return F.when(_c(hhi) > 2500, "concentrated").otherwise("diverse")


def zscore(x, mean, std, eps: float = 1e-8) -> Column:
    return (_c(x) - _c(mean)) / (_c(std) + F.lit(eps))


def round_half_even(c, digits: int) -> Column:
    """Python-style rounding of the printed value (banker's rounding)."""
    return F.bround(_c(c), digits)
