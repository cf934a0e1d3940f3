"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


# --- fixed values: white space ------------------------------------------------
# Tab to carriage return, the four separators, space, NEL, NBSP, Ogham space,
# en quad to hair space, line and paragraph separator, narrow NBSP, mathematical
# and ideographic space.
WHITE_SPACE = "".join(
    map(
        chr,
        [
            *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F,
            0x205F, 0x3000,
        ],
    )
)
# ------------------------------------------------------------------------------


def strip(value: Column) -> Column:
    """Remove all leading and trailing white space, tabs, newlines and NBSP included."""
    return F.btrim(value, F.lit(WHITE_SPACE))


def or_default(value: Column, default: Column) -> Column:
    """``default`` when the text is NULL or empty."""
    return F.coalesce(F.nullif(value, F.lit("")), default)


def location_key(latitude: Column, longitude: Column) -> Column:
    """Signed fixed-point coordinates, e.g. ``+40.6413-73.7781``; NULL where one is missing."""
    return F.concat(_four_places(latitude), _four_places(longitude))


def _four_places(value: Column) -> Column:
    """``value`` to four places, rounded by its exact binary value, halves to even.

    Java's format rounds the shortest decimal instead. The value is split into its single-precision
    part and the rest; both times 20,000 are exact, so the sign of their distance to the odd number
    that stands for the half is exact as well.
    """
    value = value.cast("double")
    size = F.abs(value)
    whole = F.floor(size * 10000.0)
    high = size.cast("float").cast("double")
    over = (high * 20000.0 - (whole * 2 + 1).cast("double")) + (size - high) * 20000.0
    units = whole + F.when(over > 0, 1).when(over < 0, 0).otherwise(whole % 2)
    sign = F.when(value.cast("string").startswith("-"), "-").otherwise("+")
    text = F.concat(
        sign, F.floor(units / 10000).cast("string"), F.lit("."), F.lpad((units % 10000).cast("string"), 4, "0")
    )
    # Beyond this the products are no longer exact; coordinates end at 360.
    return F.when(size < 100000.0, text).when(size >= 100000.0, F.format_string("%+.4f", value))
