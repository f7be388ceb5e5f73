"""DataFrame -> DataFrame operators."""

from . import joins, reshape, sections  # noqa: F401
