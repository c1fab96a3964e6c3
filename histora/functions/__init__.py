from histora.functions.exprs import (  # noqa: F401
    EPOCH, FAR_FUTURE, ts_literal, received_id, version_key, hour_floor_ntz, any_differs, asc_last,
    entity_bucket,
)
