"""Message columns. Numbers are rendered from a scaled, rounded integer so the
text is identical in every engine (no engine-specific double printing)."""

from pyspark.sql import Column, functions as F

from cabgrid.schema import CONGESTED_MESSAGE, IDLE_MESSAGE


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fixed_decimal_text(x, places: int = 2) -> Column:
    """Non-negative ``x`` rounded half-up to ``places`` decimals, as text."""
    scale = 10**places
    scaled = F.floor(_col(x) * F.lit(float(scale)) + F.lit(0.5))
    whole = F.floor(scaled / F.lit(scale)).cast("string")
    frac = F.lpad(F.pmod(scaled, F.lit(scale)).cast("string"), places, "0")
    return F.concat(whole, F.lit("."), frac) if places > 0 else whole


def _fill(template: str, value: Column) -> Column:
    before, after = template.split("{}")
    return F.concat(F.lit(before), value, F.lit(after))


def idle_message(avg_minutes) -> Column:
    return _fill(IDLE_MESSAGE, fixed_decimal_text(avg_minutes, 2))


def congested_message(cell) -> Column:
    return _fill(CONGESTED_MESSAGE, _col(cell))
