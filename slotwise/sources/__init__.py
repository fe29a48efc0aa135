"""Sources and sinks: driver-table adapter, CSV feeds, tables."""
