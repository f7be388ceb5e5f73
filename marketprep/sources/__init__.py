"""Sources and sinks: landed reports, JSON envelopes, literal tables, warehouse tables, JDBC."""

from . import envelope, facets, jdbc, literal, reports, tables  # noqa: F401
