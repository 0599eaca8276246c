"""Column expressions shared by all operators: dates, money, text and numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillworks import fixed_values as fv

MONEY = T.DecimalType(26, 6)


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- text -----------------------------------------------------------------------------------------------------------

def zero_pad(c, width: int = 5) -> Column:
    """Left zero-pad that never truncates (plain ``lpad`` does). A leading sign stays in front."""
    s = col(c).cast("string")
    signed = s.rlike("^[+-]")
    padded = F.concat(F.substring(s, 1, 1), F.lpad(F.substring(s, 2, 2147483647), width - 1, "0"))
    return F.when(F.length(s) >= width, s).when(signed, padded).otherwise(F.lpad(s, width, "0"))


def strip(c) -> Column:
    """Drop white space of any kind at both ends (``trim`` drops blanks only)."""
    return F.btrim(col(c), F.lit(" \t\n\r\f\x0b"))


def ascii_only(c) -> Column:
    """Drop every character outside ASCII."""
    return F.regexp_replace(col(c), r"[^\x00-\x7F]", "")


def null_like(c, words=("", "None", "nan", "null", "NULL")) -> Column:
    """Trim, then turn the words that stand for 'nothing' into NULL."""
    t = strip(c)
    return F.when(~t.isin(*words), t)


def canonical_id(c) -> Column:
    """'12.0' -> '12', NULL -> 'NaN', any other text trimmed."""
    s = col(c).cast("string")
    plain_number = s.rlike(r"^(\d+\.?\d*|\.\d+)$")
    whole = F.regexp_replace(F.regexp_replace(s, r"\.\d*$", ""), r"^0+(?=\d)", "")
    return (F.when(s.isNull(), F.lit("NaN"))
            .when(plain_number, F.when(whole == "", F.lit("0")).otherwise(whole))
            .otherwise(strip(s)))


def identifier(c, default: str = "UNKNOWN") -> Column:
    """Runs of characters other than word characters and '-' become one '_'; outer '_' go; empty -> default."""
    s = F.regexp_replace(strip(c), r"(?U)[^\w\-]+", "_")
    s = F.regexp_replace(F.regexp_replace(s, "_+", "_"), "^_|_$", "")
    return F.coalesce(F.nullif(s, F.lit("")), F.lit(default))


def parse_flag(c) -> Column:
    """'true'/'false' in any case -> boolean, anything else -> NULL."""
    s = F.lower(col(c).cast("string"))
    return F.when(s == "true", F.lit(True)).when(s == "false", F.lit(False))


def to_number(c, missing=None) -> Column:
    """Number or NULL (or ``missing``) for text that is not one."""
    n = col(c).cast("string").try_cast("double")
    return n if missing is None else F.coalesce(n, F.lit(missing).cast("double"))


#: How the source database compares names: without regard to case, accents and trailing blanks.
NAME_COLLATION = "UNICODE_CI_AI_RTRIM"


def casefold(c) -> Column:
    """Text for comparing without regard to case, as programs fold it: sharp s becomes ss, a dotted I keeps its dot, a final sigma is one
    like any other."""
    # a dotless i has a place of its own meanwhile; what stands between keeps the optimizer from taking lower(upper(x)) for lower(x)
    upper = F.replace(F.translate(F.upper(F.translate(col(c), "ı", "\ue000")), "Σ", "σ"), F.lit("ẞ"), F.lit("SS"))
    return F.translate(F.lower(upper), "\ue000", "ı")


def as_name(c) -> Column:
    """Text that compares, groups and joins as names do in the source database, see NAME_COLLATION."""
    return F.collate(col(c), NAME_COLLATION)


def lookup(c, table: dict[str, str], default=None, fold: bool = False) -> Column:
    """Replace by a small fixed table; with ``fold`` the key is trimmed and compared without regard to case (:func:`casefold`), and worked
    out once, not again for each entry."""
    if fold:
        pairs = F.create_map(*[F.lit(x) for k, v in {k.strip().casefold(): v for k, v in table.items()}.items() for x in (k, v)])
        out = F.try_element_at(pairs, casefold(strip(c)))
        return out if default is None else F.coalesce(out, default)
    out = None
    for k, v in table.items():
        hit = col(c) == F.lit(k)
        out = F.when(hit, F.lit(v)) if out is None else out.when(hit, F.lit(v))
    return out if default is None else out.otherwise(default)


# --- dates ----------------------------------------------------------------------------------------------------------

def local_time(ts, hours: int = 7) -> Column:
    """UTC wall time -> local wall time, on timestamps without a zone."""
    return col(ts) + F.expr(f"INTERVAL {hours} HOURS")


def week_from_monday(d) -> Column:
    """Week 1..53 counted from the first Monday of the year of that week's Monday (not the ISO week)."""
    day = F.to_date(col(d))
    monday = F.date_sub(day, F.weekday(day))
    return F.ceil(F.dayofyear(monday) / F.lit(7)).cast("int")


def iso_week(d) -> Column:
    return F.weekofyear(col(d))


def week_bounds(d) -> tuple[Column, Column]:
    """Monday and Sunday around a date."""
    day = F.to_date(col(d))
    monday = F.date_sub(day, F.weekday(day))
    return monday, F.date_add(monday, 6)


def lookback_start(as_of, days: int, not_before) -> Column:
    return F.greatest(F.date_sub(col(as_of), days), F.to_date(F.lit(not_before)))


def hour_start(ts) -> Column:
    """Start of the hour of a zone-less time (``date_trunc`` would go through the session zone)."""
    return F.to_date(col(ts)).cast("timestamp_ntz") + F.make_dt_interval(hours=F.hour(col(ts)))


def four_hour_block(ts) -> Column:
    """'08:00-11:59' style label of the 4-hour block."""
    first = (F.floor(F.hour(col(ts)) / 4) * 4).cast("int")
    two = lambda h: F.lpad(h.cast("string"), 2, "0")
    return F.concat(two(first), F.lit(":00-"), two(first + 3), F.lit(":59"))


def micros(ts) -> Column:
    """Microseconds since 1970 of a zone-less timestamp, independent of the session zone."""
    t = col(ts)
    whole = F.unix_date(F.to_date(t)).cast("bigint") * 86400 + F.hour(t) * 3600 + F.minute(t) * 60
    return whole * 1000000 + (F.date_part(F.lit("SECOND"), t) * 1000000).cast("bigint")


def from_micros(us) -> Column:
    """Inverse of :func:`micros`."""
    day = F.floor(col(us) / 86400000000).cast("int")
    rest = (col(us) - day.cast("bigint") * 86400000000) / F.lit(1000000).cast("decimal(8,0)")
    return F.date_from_unix_date(day).cast("timestamp_ntz") + F.make_dt_interval(secs=rest.cast("decimal(18,6)"))


def as_instant(ts) -> Column:
    """Zone-less time read as UTC, as the zoned type that event-time streaming asks for."""
    return F.timestamp_micros(micros(ts))


def from_instant(ts) -> Column:
    """Inverse of :func:`as_instant`."""
    return from_micros(F.unix_micros(col(ts)))


def seconds_between(start, end) -> Column:
    return (micros(end) - micros(start)) / F.lit(1e6)


def minutes_between(start, end) -> Column:
    return (micros(end) - micros(start)) / F.lit(6e7)


# --- numbers --------------------------------------------------------------------------------------------------------

MONEY_LIMIT = 9e18


def _split(c) -> tuple[Column, Column, Column]:
    """(whole units towards zero, millionths of the fraction, what is left below a millionth) of a double column; the fraction is exact.
    Without a check of the range, which one use of an amount makes for all."""
    x = col(c).cast("double")
    whole = x.try_cast("bigint")
    unit = ((x - whole) * 1e6 + F.signum(x) * 0.5).try_cast("bigint")
    return whole, unit, F.when(whole + unit / 1e6 == x, F.lit(0.0)).otherwise(x - whole - unit / 1e6)


def _checked_whole(c) -> Column:
    """Whole units of an amount; raises where it is no number or beyond MONEY_LIMIT, so that it cannot be added exactly."""
    x = col(c).cast("double")
    return F.when(x.isNull() | (F.abs(x) < MONEY_LIMIT), _split(c)[0]).otherwise(
        F.raise_error(F.concat(F.lit("amount outside the range of exact sums: "), x.cast("string"))).cast("bigint"))


def money(c) -> Column:
    """Millionths as a decimal, half away from zero; raises as :func:`exact_sum` does. :func:`money_rest` is what it leaves out."""
    unit = _split(c)[1].cast("decimal(7,0)") * F.lit("0.000001").cast("decimal(7,6)")
    return (_checked_whole(c).cast("decimal(20,0)") + unit).cast(MONEY)


def money_rest(c) -> Column:
    """What :func:`money` leaves out: 0 where the amount is a number of millionths."""
    return _split(c)[2]


def money_state(c) -> Column:
    """Exact sum of a double column as a struct of partial sums, to be added further by :func:`merged_money`; :func:`money_value` is the sum.

    Whole units go to two long sums, of their high part and their low 24 bits, and the millionths of the fractions to a third; none
    overflows before 5e11 rows. What amounts have below a millionth goes to a double. NaN, infinity and amounts beyond MONEY_LIMIT raise.
    """
    whole, unit, rest = _split(c)
    return F.struct(F.sum(F.shiftright(_checked_whole(c), 24)).alias("high"),
                    F.sum(whole.bitwiseAND(F.lit((1 << 24) - 1).cast("bigint"))).alias("low"), F.sum(unit).alias("unit"), F.sum(rest).alias("rest"))


def merged_money(state: str) -> Column:
    """The sum of :func:`money_state` structs, as one more of them."""
    return F.struct(*[F.sum(f"{state}.{part}").alias(part) for part in ("high", "low", "unit", "rest")])


def money_units(state) -> Column:
    """DECIMAL(38,6) of a :func:`money_state`: the sum in millionths."""
    s = col(state)
    units = (s["high"].cast("decimal(20,0)") * F.lit(1 << 24).cast("decimal(8,0)") + s["low"].cast("decimal(20,0)")).cast("decimal(30,0)")
    return units + s["unit"].cast("decimal(20,0)") * F.lit("0.000001").cast("decimal(7,6)")


def money_value(state) -> Column:
    """The sum of a :func:`money_state` as a double; NULL over no rows, as in SQL."""
    return money_units(state).cast("double") + col(state)["rest"]


def exact_sum(c) -> Column:
    """Sum of a double column as DECIMAL(38,6), in millionths: independent of row order; :func:`exact_rest` has what is smaller. A decimal
    sum does the same, at a higher cost."""
    return money_units(money_state(c))


def exact_rest(c) -> Column:
    """Sum of what a column's amounts have below a millionth: 0 for amounts of up to six decimals."""
    return F.sum(_split(c)[2])


def money_sum(c) -> Column:
    """:func:`exact_sum` and :func:`exact_rest` as a double; NULL over no rows, as in SQL."""
    return money_value(money_state(c))


def array_money_sum(items, value) -> Column:
    """:func:`money_sum` over the items of an array; ``value`` gives an item's amount, NULL counts as 0. 0 for an empty array."""
    wide = "decimal(38,6)"
    amount = lambda x: F.coalesce(value(x), F.lit(0.0))
    start = F.struct(F.lit(0).cast(wide).alias("units"), F.lit(0.0).alias("rest"))
    add = lambda a, x: F.struct((a["units"] + money(amount(x))).cast(wide).alias("units"),
                                (a["rest"] + money_rest(amount(x))).alias("rest"))
    return F.aggregate(items, start, add, lambda a: a["units"].cast("double") + a["rest"])


def money_total(c) -> Column:
    """As :func:`money_sum`, but 0 when there is nothing to add."""
    return F.coalesce(money_sum(c), F.lit(0.0))


def ratio(a, b) -> Column:
    """Division giving NULL for a zero divisor."""
    return F.try_divide(col(a).cast("double"), F.nullif(col(b).cast("double"), F.lit(0.0)))


def np_round(c, digits: int) -> Column:
    """Scale, round half to even, scale back: what array libraries do (``round`` here would go half up on the decimal text)."""
    return F.rint(col(c) * F.lit(10.0 ** digits)) / F.lit(10.0 ** digits)


def haversine(lat1, lng1, lat2, lng2) -> Column:
    """Great-circle distance in metres, 2 decimals; NULL when any coordinate is."""
    p1, p2 = F.radians(col(lat1)), F.radians(col(lat2))
    dp = F.radians(col(lat2) - col(lat1))
    dl = F.radians(col(lng2) - col(lng1))
    a = F.pow(F.sin(dp / 2), F.lit(2)) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dl / 2), F.lit(2))
    return np_round(F.lit(2 * fv.EARTH_RADIUS_M) * F.asin(F.sqrt(a)), 2)


def detour(route, straight) -> Column:
    """Route ÷ straight line, only where the straight line is positive, 3 decimals."""
    return np_round(F.when(col(straight) > 0, col(route) / col(straight)), 3)
