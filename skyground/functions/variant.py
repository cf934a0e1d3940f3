"""Typed access to VARIANT leaves, and checks of whole groups of leaves.

A leaf can be missing, an explicit JSON null, a usable value or a value of the
wrong kind, and the parsers treat the four differently.

Checks look at all leaves of a kind at once, through one text and one pattern.
A rule per leaf would generate a method too long for the JIT compiler, and the
parse would run interpreted.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import VariantType

# --- fixed values: what counts as a number -----------------------------------
# A JSON null, boolean or number, or text holding a decimal number. The JVM also
# reads 1.5d, 2f and 0x1p3 as numbers; those are no decimal numbers.
_NUMBER = (
    r"(?:null|true|false|-?[0-9][0-9.eE+-]*"
    r'|"\s*[+-]?(?:(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?|(?i:inf|infinity|nan))\s*")'
)
ALL_NUMBERS = rf"^\[{_NUMBER}(?:,{_NUMBER})*\]$"
ALL_WHOLE = r"^(?:(?:BIGINT|VOID)(?:,|$))*$"
# Where a stored column of leaves holds fractions as well, its whole numbers read as decimals without a place.
ALL_STORED_WHOLE = r"^(?:(?:BIGINT|VOID|DECIMAL\([0-9]+,0\))(?:,|$))*$"
ALL_COMPARABLE = r"^(?:(?:BIGINT|DOUBLE|BOOLEAN|DECIMAL\([0-9]+,[0-9]+\))(?:,|$))*$"
ALL_OBJECTS = r"^(?:OBJECT(?:,|$))*$"
# Range of a timestamp with a four-digit year, in seconds.
FIRST_SECOND, LAST_SECOND = -62135596800, 253402300799
# ------------------------------------------------------------------------------


def with_computed(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that is computed once per row.

    Catalyst copies the definition of an ordinary column into every filter on
    it, which would parse a payload once per rule. It cannot do so through a
    generator, and exploding a one-element array leaves the rows as they are.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def document(payload: str | Column) -> Column:
    """The payload text as VARIANT; NULL when it is not JSON."""
    return F.try_parse_json(payload)


def landed_document(landing: DataFrame) -> Column:
    """The document of a landed row: its VARIANT where one was stored, else its text parsed."""
    if "parsed" in landing.columns and isinstance(landing.schema["parsed"].dataType, VariantType):
        return F.col("parsed")
    return document("payload")


def node(doc: Column, path: str) -> Column:
    """The raw sub-value: NULL when missing, a variant null when explicitly null."""
    return F.try_variant_get(doc, path, "variant")


def items(doc: Column, path: str) -> Column:
    """The elements of an array; NULL when there is no array at ``path``."""
    return F.try_variant_get(doc, path, "array<variant>")


def text(doc: Column, path: str = "$") -> Column:
    """The leaf as text; arrays and objects keep their JSON form."""
    return F.try_variant_get(doc, path, "string")


def number(doc: Column, path: str = "$") -> Column:
    """Number, or text holding one, as double. See :func:`bad_numbers`."""
    return F.try_variant_get(doc, path, "double")


def integer(doc: Column, path: str = "$") -> Column:
    """Number cut toward zero, or text holding a whole number, as int. See :func:`bad_integers`."""
    return F.try_variant_get(doc, path, "int")


def kind(doc: Column, path: str = "$") -> Column:
    """STRING, BIGINT, DECIMAL(p,s), DOUBLE, BOOLEAN, VOID, ARRAY<..> or OBJECT<..>."""
    return F.schema_of_variant(doc if path == "$" else node(doc, path))


def truth(doc: Column, path: str = "$") -> Column:
    """Truthiness: 0, empty text, [] and {} are false; any other text is true."""
    raw = text(doc, path)
    return F.coalesce(
        F.when(kind(doc, path) == "STRING", raw != ""),
        F.try_variant_get(doc, path, "boolean"),
        ~raw.isin("[]", "{}"),
    )


def is_object(doc: Column, path: str = "$") -> Column:
    return F.coalesce(kind(doc, path).startswith("OBJECT"), F.lit(False))


def _present(raw: Column) -> Column:
    return raw.isNotNull() & ~F.is_variant_null(raw)


def _kinds(raws: tuple[Column, ...]) -> Column:
    """The kinds of the leaves that are there, comma separated."""
    return F.concat_ws(",", *[F.schema_of_variant(raw) for raw in raws])


def bad_numbers(*raws: Column) -> Column:
    """True when a leaf is there but :func:`number` must not be used on it."""
    return ~F.to_json(F.array(*raws)).rlike(ALL_NUMBERS)


def bad_integers(*raws: Column) -> Column:
    """True when a leaf is there but is no int: other text, or out of range."""
    return reduce(or_, [integer(raw).isNull() & _present(raw) for raw in raws])


def bad_whole(*raws: Column, stored: bool = False) -> Column:
    """True when a leaf is there but is no JSON whole number in int range; ``stored`` documents do not tell 5.0 from 5."""
    return ~_kinds(raws).rlike(ALL_STORED_WHOLE if stored else ALL_WHOLE) | bad_integers(*raws)


def bad_measures(*raws: Column) -> Column:
    """True when a leaf is there, explicit nulls included, but compares to no number."""
    return ~_kinds(raws).rlike(ALL_COMPARABLE)


def bad_sections(*raws: Column) -> Column:
    """True when something other than an object is there, explicit nulls included."""
    return ~F.concat_ws(",", *[F.left(F.schema_of_variant(raw), F.lit(6)) for raw in raws]).rlike(ALL_OBJECTS)


def _seconds(raw: Column) -> Column:
    return F.when(kind(raw) != "STRING", number(raw))


def epoch(doc: Column, path: str) -> Column:
    """Epoch seconds as timestamp; 0 and other falsy leaves are NULL. See :func:`bad_epochs`."""
    seconds = _seconds(node(doc, path))
    usable = seconds.between(FIRST_SECOND, LAST_SECOND) & (seconds != 0)
    return F.timestamp_seconds(F.when(usable, seconds))


def bad_epochs(*raws: Column) -> Column:
    """True when a leaf is neither falsy nor a number of seconds in the years 1 to 9999."""

    def bad(raw: Column) -> Column:
        usable = F.coalesce(_seconds(raw).between(FIRST_SECOND, LAST_SECOND), F.lit(False))
        return _present(raw) & ~usable & ~text(raw).isin("", "[]", "{}")

    return reduce(or_, [bad(raw) for raw in raws])
