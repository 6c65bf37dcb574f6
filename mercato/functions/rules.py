"""Business rules as built-in column expressions (JVM side, codegen-friendly).

No Python UDFs: every rule is a ``when`` chain or a built-in function.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Labels, thresholds and names that must equal the reference.
NO_RAIN = "No Rain"
LIGHT_RAIN = "Light Rain"
HEAVY_RAIN = "Heavy Rain"
RAIN_CATEGORIES = [NO_RAIN, LIGHT_RAIN, HEAVY_RAIN]
LIGHT_RAIN_BELOW_MM = 5

HOT = "Hot"
WARM = "Warm"
COOL = "Cool"
TEMP_CATEGORIES = [HOT, WARM, COOL]
HOT_FROM_C = 30
WARM_FROM_C = 22

LATE = "Late"
ON_TIME = "On Time"
UNKNOWN = "Unknown"
OTHERS = "Others"
DELIVERED = "delivered"

MONTH_NAMES = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]

# Brazilian state codes and names used by the dashboard's state lookup.
BR_STATES = {
    "AC": "Acre", "AL": "Alagoas", "AM": "Amazonas", "AP": "Amapá", "BA": "Bahia",
    "CE": "Ceará", "DF": "Distrito Federal", "ES": "Espírito Santo", "GO": "Goiás",
    "MA": "Maranhão", "MG": "Minas Gerais", "MS": "Mato Grosso do Sul",
    "MT": "Mato Grosso", "PA": "Pará", "PB": "Paraíba", "PE": "Pernambuco",
    "PI": "Piauí", "PR": "Paraná", "RJ": "Rio de Janeiro", "RN": "Rio Grande do Norte",
    "RO": "Rondônia", "RR": "Roraima", "RS": "Rio Grande do Sul", "SC": "Santa Catarina",
    "SE": "Sergipe", "SP": "São Paulo", "TO": "Tocantins",
}
# ---------------------------------------------------------------------------


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def rain_category(precipitation, null_policy: str = "heavy") -> Column:
    """0 -> No Rain, < 5 -> Light Rain, else Heavy Rain.

    ``null_policy='heavy'`` lets NULL fall to the last branch (ETL aggregate);
    ``'no_rain'`` treats NULL as 0 (enriched table, dashboard).
    """
    p = _c(precipitation)
    if null_policy == "no_rain":
        p = F.coalesce(p, F.lit(0.0))
    elif null_policy != "heavy":
        raise ValueError(f"unknown null_policy {null_policy!r}")
    return (
        F.when(p == 0, F.lit(NO_RAIN))
        .when(p < LIGHT_RAIN_BELOW_MM, F.lit(LIGHT_RAIN))
        .otherwise(F.lit(HEAVY_RAIN))
    )


def rain_order(category, unknown: int = 4, first: int = 1) -> Column:
    """Rank of a rain label: No / Light / Heavy = first, first+1, first+2;
    any other label ``unknown``."""
    c = _c(category)
    return (
        F.when(c == NO_RAIN, first).when(c == LIGHT_RAIN, first + 1).when(c == HEAVY_RAIN, first + 2)
        .otherwise(unknown)
    )


def temp_category(temp_max) -> Column:
    t = _c(temp_max)
    return F.when(t >= HOT_FROM_C, F.lit(HOT)).when(t >= WARM_FROM_C, F.lit(WARM)).otherwise(F.lit(COOL))


def delivery_status(was_late) -> Column:
    return F.when(_c(was_late) == 1, F.lit(LATE)).otherwise(F.lit(ON_TIME))


def late_label(was_late) -> Column:
    w = _c(was_late)
    return F.when(w == 0, F.lit(ON_TIME)).when(w == 1, F.lit(LATE)).otherwise(F.lit(UNKNOWN))


def was_late(delivery_date, estimated_date) -> Column:
    """1 when delivered after the estimated day (dates, not times); NULL -> 0."""
    return F.when(_c(delivery_date) > _c(estimated_date), F.lit(1)).otherwise(F.lit(0))


def period(year, month) -> Column:
    """'YYYY-MM'; NULL year or month gives NULL."""
    return F.concat(_c(year).cast("string"), F.lit("-"), F.lpad(_c(month).cast("string"), 2, "0"))


def month_name(month) -> Column:
    return F.element_at(F.array(*[F.lit(m) for m in MONTH_NAMES]), _c(month))


def upper_contains(column, query: str, regex: bool = False) -> Column:
    """Case-insensitive search; NULL never matches."""
    c = _c(column)
    if regex:
        return F.coalesce(c.rlike("(?i)" + query), F.lit(False))
    return F.coalesce(F.upper(c).contains(query.upper()), F.lit(False))


def pct(numerator, denominator, scale: int = 1) -> Column:
    """round(100 * n / d, scale); NULL when d is 0 (never raises under ANSI)."""
    return F.round(F.try_divide(_c(numerator).cast("double") * F.lit(100.0), _c(denominator)), scale)


def to_number(column, to: str = "double") -> Column:
    """Like pandas to_numeric(errors='coerce'): bad text -> NULL."""
    return _c(column).try_cast(to)
