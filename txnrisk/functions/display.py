"""Text forms of numbers for people to read."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def money(name: str) -> Column:
    """1234.5 as ``$1,234.50``."""
    return F.concat(F.lit("$"), F.format_number(F.col(name), 2))


def percent(name: str) -> Column:
    """0.1234 as ``12.34%``, without thousands separators.

    ``format_number`` rounds the exact value of the double, as C and Python do;
    ``format_string`` would round its shortest decimal form.
    """
    digits = F.translate(F.format_number(F.col(name) * 100, 2), ",", "")
    return F.concat(digits, F.lit("%"))
