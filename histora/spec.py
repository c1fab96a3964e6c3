"""Column contracts.

A change log is described by a frozen :class:`ChangeLogSpec`, so every operator is generic over the
entity key, the mutation id, the attribute list and the two clocks (source time orders and bounds the
history; ingest time is only ever used as an arrival watermark). The defaults describe the customer
change log of the reference data model.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class ChangeLogSpec:
    entity: str = "customer_id"
    change_id: str = "change_id"
    operation: str = "operation"
    attributes: tuple[str, ...] = ("country_code", "subscription_tier", "account_status", "email_verified")
    source_ts: str = "source_updated_at"
    ingest_ts: str = "ingested_at"
    extra: tuple[str, ...] = ("scenario_tag",)
    delete_value: str = "DELETE"
    received_id: str = "received_id"
    version_id: str = "customer_version_id"

    @property
    def log_columns(self) -> list[str]:
        """Raw log columns in their canonical order."""
        return [self.change_id, self.entity, self.operation, *self.attributes,
                self.source_ts, self.ingest_ts, *self.extra]

    @property
    def staged_columns(self) -> list[str]:
        return [*self.log_columns, self.received_id]

    @property
    def dimension_columns(self) -> list[str]:
        return [self.version_id, self.entity, *self.attributes, "valid_from", "valid_to",
                "row_current", "source_change_id", "last_seen_ingested_at"]


@dataclass(frozen=True)
class EventSpec:
    event_id: str = "event_id"
    entity: str = "customer_id"
    event_name: str = "event_name"
    event_ts: str = "event_timestamp"

    @property
    def columns(self) -> list[str]:
        return [self.event_id, self.entity, self.event_name, self.event_ts]


DEFAULT_SPEC = ChangeLogSpec()
DEFAULT_EVENTS = EventSpec()

# Fixed input contracts (typed, never inferred).
CDC_SCHEMA = T.StructType([
    T.StructField("change_id", T.StringType()),
    T.StructField("customer_id", T.IntegerType()),
    T.StructField("operation", T.StringType()),
    T.StructField("country_code", T.StringType()),
    T.StructField("subscription_tier", T.StringType()),
    T.StructField("account_status", T.StringType()),
    T.StructField("email_verified", T.BooleanType()),
    T.StructField("source_updated_at", T.TimestampNTZType()),
    T.StructField("ingested_at", T.TimestampNTZType()),
    T.StructField("scenario_tag", T.StringType()),
])

EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("customer_id", T.IntegerType()),
    T.StructField("event_name", T.StringType()),
    T.StructField("event_timestamp", T.TimestampNTZType()),
])
