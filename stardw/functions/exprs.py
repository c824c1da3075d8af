"""Column-level business rules.

Every rule is a native Spark expression (CASE chains, map lookups, integer
arithmetic) so it stays inside whole-stage codegen; no Python UDF is used.
"""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from stardw.functions import lookups as L
from stardw.params import Params

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _dec(v: Decimal | int | float) -> Column:
    """Decimal literal, so comparisons against DECIMAL columns stay exact."""
    d = Decimal(str(v))
    digits = max(len(d.as_tuple().digits), 1)
    scale = max(-d.as_tuple().exponent, 0)
    return F.lit(d).cast(f"decimal({max(digits, scale + 1)},{scale})")


# ---------------------------------------------------------------- lookups

def region_of(state: ColumnOrName) -> Column:
    """State code -> macro region, unknown or NULL state -> "Other".  A literal
    map lookup: no join, no shuffle."""
    region_map = F.create_map(*[F.lit(x) for kv in L.STATE_REGION.items() for x in kv])
    return F.coalesce(region_map[_c(state)], F.lit(L.REGION_DEFAULT))


def category_group(category: ColumnOrName) -> Column:
    """first group (declaration order) whose keyword is a substring of the
    lower-cased category; NULL / empty / no match -> "Other"."""
    low = F.lower(_c(category))
    expr = None
    for group, keywords in L.CATEGORY_GROUP_KEYWORDS:
        cond = reduce(lambda a, b: a | b, [low.contains(k) for k in keywords])
        expr = F.when(cond, group) if expr is None else expr.when(cond, group)
    return expr.otherwise(L.GROUP_DEFAULT)


# ---------------------------------------------------------------- classifiers

def price_band(list_price: ColumnOrName, p: Params) -> Column:
    """P10: NULL -> Unknown, < budget Budget, < mid Mid, < premium Premium, else Luxury."""
    x = _c(list_price)
    return (F.when(x.isNull(), "Unknown")
            .when(x < _dec(p.band_budget), "Budget")
            .when(x < _dec(p.band_mid), "Mid")
            .when(x < _dec(p.band_premium), "Premium")
            .otherwise("Luxury"))


def is_premium(list_price: ColumnOrName, p: Params) -> Column:
    """NULL-is-false comparison (a missing price is not premium)."""
    return F.coalesce(_c(list_price) >= _dec(p.premium_min), F.lit(False))


def customer_segment(order_count: ColumnOrName) -> Column:
    """1 -> Occasional, <= 4 -> Regular (0 included), else Loyal."""
    n = _c(order_count)
    return F.when(n == 1, "Occasional").when(n <= 4, "Regular").otherwise("Loyal")


def seller_size(item_count: ColumnOrName, p: Params) -> Column:
    """NULL or < small -> Small, < medium -> Medium, else Large."""
    n = _c(item_count)
    return (F.when(n.isNull() | (n < p.size_small), "Small")
            .when(n < p.size_medium, "Medium").otherwise("Large"))


def seller_tier(price_sum: ColumnOrName, p: Params) -> Column:
    """NULL or < bronze -> Bronze, < silver -> Silver, else Gold."""
    r = _c(price_sum)
    return (F.when(r.isNull() | (r < _dec(p.tier_bronze)), "Bronze")
            .when(r < _dec(p.tier_silver), "Silver").otherwise("Gold"))


def age_group(age: ColumnOrName) -> Column:
    """Right-closed bins; outside every bin or NULL -> "nan"."""
    a = _c(age)
    expr = None
    for lo, hi, label in L.AGE_BINS:
        cond = (a > lo) & (a <= hi)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(L.AGE_OUT_OF_RANGE)


# ---------------------------------------------------------------- time

def lenient_timestamp(c: ColumnOrName) -> Column:
    """parse; unparsable, or beyond the range of 64-bit nanoseconds around
    1970 (which the source's parser gives up on) -> NULL."""
    t = _c(c).try_cast("timestamp_ntz")
    lo, hi = (F.lit(x).cast("timestamp_ntz") for x in L.TIMESTAMP_RANGE)
    return F.when(t.between(lo, hi), t)


def date_key(c: ColumnOrName) -> Column:
    """K3: YYYYMMDD smart key as INT; NULL -> NULL.  Integer arithmetic, no string formatting."""
    d = F.to_date(_c(c))
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def month_name(c: ColumnOrName) -> Column:
    """English month name, whatever the JVM locale."""
    return F.element_at(F.array(*[F.lit(m) for m in L.MONTH_NAMES]), F.month(_c(c)))


def weekday_name(c: ColumnOrName) -> Column:
    """English weekday name (Monday = weekday 0), whatever the JVM locale."""
    return F.element_at(F.array(*[F.lit(d) for d in L.WEEKDAY_NAMES]), F.weekday(_c(c)) + 1)


def elapsed_days(start: ColumnOrName, end: ColumnOrName) -> Column:
    """floor of elapsed time / 24 h (negative spans floor down); NULL if either is NULL."""
    micros = F.timestamp_diff("MICROSECOND", _c(start), _c(end))
    day = F.lit(86_400_000_000)
    return ((micros - F.pmod(micros, day)) / day).cast("int")


def on_time_flag(delivered: ColumnOrName, estimated: ColumnOrName) -> Column:
    """NULL if either side is missing, 1 if delivered <= estimated (full timestamps), else 0."""
    d, e = _c(delivered), _c(estimated)
    return (F.when(d.isNull() | e.isNull(), F.lit(None))
            .when(d <= e, F.lit(1)).otherwise(F.lit(0))).cast("smallint")


# ---------------------------------------------------------------- exact money arithmetic

def cents(c: ColumnOrName) -> Column:
    """DECIMAL(.,2) money -> BIGINT cents (exact)."""
    return (_c(c) * 100).cast("long")


def half_up_ratio(num: ColumnOrName, den: ColumnOrName, scale: int,
                  precision: int = 18) -> Column:
    """Exact ``round_half_up(num / den, scale)`` for integral num/den, as DECIMAL.

    Uses integer division on DECIMAL(38,0) so neither engine rounds twice or
    goes through a double; NULL when den is NULL or 0.  Negative numerators
    round half away from zero.
    """
    n = _c(num).cast("decimal(38,0)")
    d = _c(den).cast("decimal(38,0)")
    pow10 = F.lit(10 ** scale).cast("decimal(38,0)")
    mag = F.abs(n) * 2 * pow10 + d
    q = F.when(d > 0, F.signum(n).cast("long") * _int_div(mag, d * 2))
    unit = F.lit(Decimal(1).scaleb(-scale)).cast(f"decimal({scale + 1},{scale})") if scale else F.lit(1)
    return (q.cast("decimal(38,0)") * unit).cast(f"decimal({precision},{scale})")


def _int_div(a: Column, b: Column) -> Column:
    """Spark SQL's integral division ``a div b`` (truncates toward zero, exact
    for DECIMAL(38,0) operands, result BIGINT)."""
    return F.call_function("div", a, b)


# ---------------------------------------------------------------- simulated attributes

def sim_hash(key: ColumnOrName, seed: int, part: int) -> Column:
    """Deterministic 32-bit value for an entity key: bytes 4*part..4*part+3 of
    md5("<seed>:<key>").  Independent of row order and partitioning, and the
    same text in every SQL engine that has md5."""
    h = F.md5(F.concat(F.lit(f"{seed}:"), _c(key).cast("string")))
    return F.conv(F.substring(h, 8 * part + 1, 8), 16, 10).cast("long")


def sim_age(key: ColumnOrName, p: Params) -> Column:
    """G1: uniform AGE_MIN..AGE_MAX."""
    span = L.AGE_MAX - L.AGE_MIN + 1
    return (F.lit(L.AGE_MIN) + sim_hash(key, p.seed, 0) % span).cast("smallint")


def sim_gender(key: ColumnOrName, p: Params) -> Column:
    """M with MALE_PERCENT %, F otherwise."""
    return F.when(sim_hash(key, p.seed, 1) % 100 < L.MALE_PERCENT, "M").otherwise("F")


def sim_signup_date(key: ColumnOrName, first_order: ColumnOrName, p: Params) -> Column:
    """First order date minus SIGNUP_DAYS_MIN..MAX days; NULL without an order."""
    span = L.SIGNUP_DAYS_MAX - L.SIGNUP_DAYS_MIN + 1
    days = (F.lit(L.SIGNUP_DAYS_MIN) + sim_hash(key, p.seed, 2) % span).cast("int")
    return F.date_sub(F.to_date(_c(first_order)), days)


def sim_seller_join_date(key: ColumnOrName, p: Params) -> Column:
    """seller_epoch minus SELLER_JOIN_DAYS_MIN..MAX days."""
    span = L.SELLER_JOIN_DAYS_MAX - L.SELLER_JOIN_DAYS_MIN + 1
    days = (F.lit(L.SELLER_JOIN_DAYS_MIN) + sim_hash(key, p.seed, 3) % span).cast("int")
    return F.date_sub(F.lit(p.seller_epoch), days)
