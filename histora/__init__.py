"""histora: bitemporal change-log analytics on PySpark.

Rebuilds historically correct entity state (SCD Type 2 with half-open validity intervals) from
append-only change logs whose deliveries are duplicated, late, out of order, replayed or deleted,
joins events to the state valid at event time, repairs late arrivals incrementally and checks the
temporal integrity of the result. Everything is a DataFrame in, DataFrame out.
"""

from histora.spec import ChangeLogSpec, EventSpec, CDC_SCHEMA, EVENT_SCHEMA, DEFAULT_SPEC, DEFAULT_EVENTS

__all__ = ["ChangeLogSpec", "EventSpec", "CDC_SCHEMA", "EVENT_SCHEMA", "DEFAULT_SPEC", "DEFAULT_EVENTS"]
