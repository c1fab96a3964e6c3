from histora.operators.staging import stage_changes, stage_events  # noqa: F401
from histora.operators.changes import (  # noqa: F401
    deduplicate_changes, sequence_changes, duplicate_deliveries, noop_changes, arrival_anomalies,
    shared_change_ids, unstable_change_ids,
)
from histora.operators.scd2 import build_scd2, current_state, history, entity_watermarks  # noqa: F401
from histora.operators.pit import point_in_time_join  # noqa: F401
from histora.operators.incremental import (  # noqa: F401
    high_water, affected_entities, repair_scd2, repair_scd2_tail, append_facts, event_high_water, repair_stored,
    append_stored, moved_events, affected_entities_stored,
)
from histora.operators.quality import (  # noqa: F401
    overlap_counts, overlap_violations, current_record_violations, interval_order_violations, not_null_violations,
    unique_violations, accepted_values_violations, table_diff, table_diff_by_bucket,
    unequal_buckets, missing_scenarios, validate,
)
