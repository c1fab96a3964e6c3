from histora.sources.readers import read_change_log, read_events, read_table  # noqa: F401
from histora.sources.derived import derived_change_log, derived_facts, scenario_catalog  # noqa: F401
