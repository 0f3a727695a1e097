"""Text clean-up and display formatting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MISSING = "—"

# Leading or trailing white space, Unicode included, plus the four ASCII separators.
_EDGES = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"


def blank_to_null(text: Column) -> Column:
    """Strip white space on both sides; what is left empty becomes null."""
    return F.nullif(F.regexp_replace(text, _EDGES, ""), F.lit(""))


def fixed_decimals(value: Column, places: int) -> Column:
    """``value`` with a fixed number of decimals, rounded from the exact binary value, ties to even.

    ``format_string`` rounds the shortest decimal text half up instead, so 0.25 would print as 0.3.
    Spark's pattern form of ``format_number`` does what is wanted except on one value per precision,
    a lone 5 right behind the last place, which lies just above the tie and has to go up.
    """
    if places == 0:
        return F.call_function("format_number", value, F.lit("0"))
    lone_five = float(f"5e-{places + 1}")
    nudged = F.when(F.abs(value) == lone_five, F.signum(value) * float(f"1e-{places}")).otherwise(value)
    return F.call_function("format_number", nudged, F.lit("0." + "0" * places))


def _present(value: Column) -> Column:
    return value.isNotNull() & ~F.isnan(value)


def concentration(value: Column) -> Column:
    """A dash if missing, four decimals below 1 in magnitude, else one decimal."""
    shown = F.when(F.abs(value) < 1, fixed_decimals(value, 4)).otherwise(fixed_decimals(value, 1))
    return F.when(_present(value), shown).otherwise(MISSING)


def measure(value: Column, places: int) -> Column:
    """P10: a number with fixed decimals, or a dash if missing."""
    return F.when(_present(value), fixed_decimals(value, places)).otherwise(MISSING)


def yes_no(flag: Column) -> Column:
    """P10: Yes if true, No if false or missing."""
    return F.when(flag, "Yes").otherwise("No")


def day_label(name: Column, day: Column) -> Column:
    """``name (yyyy-mm-dd)``; null if either part is null."""
    return F.concat(name, F.lit(" ("), day.cast("string"), F.lit(")"))
