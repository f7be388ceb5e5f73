"""Column -> Column functions (strings, numbers, dates)."""

from . import calendar, numeric, text  # noqa: F401
