"""Scripted change-log rows and their expected history (hand-made test inputs, see FIXTURES.md)."""

# Fixed test data: 51 scripted deliveries (CSV with header).
SCRIPTED_LOG_CSV = """\
change_id,customer_id,operation,country_code,subscription_tier,account_status,email_verified,source_updated_at,ingested_at,scenario_tag
chg_001_insert,1,INSERT,US,free,active,false,2026-01-15 09:00:00,2026-01-15 09:01:00,normal_insert
chg_002_insert,2,INSERT,US,free,active,false,2026-01-20 09:00:00,2026-01-20 09:01:00,normal_update
chg_002_update,2,UPDATE,CA,plus,active,false,2026-03-01 10:00:00,2026-03-01 10:01:00,normal_update
chg_003_insert,3,INSERT,US,free,active,false,2026-02-01 09:00:00,2026-02-01 09:01:00,normal_delete
chg_003_update,3,UPDATE,US,plus,active,false,2026-02-10 09:00:00,2026-02-10 09:01:00,normal_delete
chg_003_delete,3,DELETE,US,plus,active,false,2026-02-20 09:00:00,2026-02-20 09:01:00,normal_delete
chg_010_insert,10,INSERT,US,free,active,false,2026-03-01 09:00:00,2026-03-01 09:01:00,duplicate_delivery
chg_010_update,10,UPDATE,GB,plus,active,false,2026-03-05 12:00:00,2026-03-05 12:01:00,duplicate_delivery
chg_010_update,10,UPDATE,GB,plus,active,false,2026-03-05 12:00:00,2026-03-05 12:02:00,duplicate_delivery
chg_011_insert,11,INSERT,DE,free,active,false,2026-03-10 09:00:00,2026-03-10 09:01:00,full_batch_replay
chg_011_update,11,UPDATE,DE,premium,active,false,2026-03-15 09:00:00,2026-03-15 09:01:00,full_batch_replay
chg_011_insert,11,INSERT,DE,free,active,false,2026-03-10 09:00:00,2026-03-17 09:01:00,full_batch_replay
chg_011_update,11,UPDATE,DE,premium,active,false,2026-03-15 09:00:00,2026-03-22 09:01:00,full_batch_replay
chg_012_insert,12,INSERT,US,free,active,false,2026-04-01 09:00:00,2026-04-01 09:01:00,late_arriving
chg_012_later,12,UPDATE,US,premium,active,false,2026-04-20 09:00:00,2026-04-20 09:01:00,late_arriving
chg_012_late,12,UPDATE,FR,free,active,false,2026-04-10 09:00:00,2026-04-22 09:00:00,late_arriving
chg_013_insert,13,INSERT,US,free,active,false,2026-04-01 08:00:00,2026-04-01 08:01:00,out_of_order
chg_013_second,13,UPDATE,AU,plus,active,false,2026-04-08 08:00:00,2026-04-06 08:00:00,out_of_order
chg_013_first,13,UPDATE,AU,free,active,false,2026-04-04 08:00:00,2026-04-09 08:00:00,out_of_order
chg_014_insert,14,INSERT,US,free,active,false,2026-05-01 09:00:00,2026-05-01 09:01:00,stale_change
chg_014_newer,14,UPDATE,JP,premium,active,false,2026-05-20 09:00:00,2026-05-20 09:01:00,stale_change
chg_014_stale,14,UPDATE,JP,plus,active,false,2026-05-10 09:00:00,2026-05-21 09:00:00,stale_change
chg_015_insert,15,INSERT,US,free,active,false,2026-01-05 09:00:00,2026-01-05 09:01:00,multiple_changes
chg_015_u1,15,UPDATE,CA,free,active,false,2026-01-12 09:00:00,2026-01-12 09:01:00,multiple_changes
chg_015_u2,15,UPDATE,CA,plus,active,false,2026-01-20 09:00:00,2026-01-20 09:01:00,multiple_changes
chg_015_u3,15,UPDATE,CA,plus,active,true,2026-02-01 09:00:00,2026-02-01 09:01:00,multiple_changes
chg_015_u4,15,UPDATE,CA,plus,paused,true,2026-02-15 09:00:00,2026-02-15 09:01:00,multiple_changes
chg_015_u5,15,UPDATE,CA,premium,paused,true,2026-03-01 09:00:00,2026-03-01 09:01:00,multiple_changes
chg_016_insert,16,INSERT,US,free,active,false,2026-06-01 09:00:00,2026-06-01 09:01:00,multi_attribute
chg_016_multi,16,UPDATE,BR,premium,paused,true,2026-06-08 09:00:00,2026-06-08 09:01:00,multi_attribute
chg_017_insert,17,INSERT,US,free,active,false,2026-06-10 08:00:00,2026-06-10 08:01:00,same_day
chg_017_afternoon,17,UPDATE,US,plus,active,true,2026-06-10 16:30:00,2026-06-10 16:31:00,same_day
chg_018_insert,18,INSERT,US,free,active,false,2026-04-01 09:00:00,2026-04-01 09:01:00,same_timestamp_conflict
chg_018_a,18,UPDATE,FR,free,active,false,2026-04-15 12:00:00,2026-04-15 12:05:00,same_timestamp_conflict
chg_018_b,18,UPDATE,GB,free,active,false,2026-04-15 12:00:00,2026-04-15 12:06:00,same_timestamp_conflict
chg_019_insert,19,INSERT,AU,free,active,false,2026-05-01 09:00:00,2026-05-01 09:01:00,update_then_delete
chg_019_update,19,UPDATE,AU,plus,active,false,2026-05-08 09:00:00,2026-05-08 09:01:00,update_then_delete
chg_019_delete,19,DELETE,AU,plus,active,false,2026-05-12 09:00:00,2026-05-12 09:01:00,update_then_delete
chg_020_insert,20,INSERT,US,free,active,false,2026-01-01 09:00:00,2026-01-01 09:01:00,late_interval_repair
chg_020_later,20,UPDATE,US,premium,active,false,2026-01-20 09:00:00,2026-01-20 09:01:00,late_interval_repair
chg_020_late,20,UPDATE,DE,free,active,false,2026-01-10 09:00:00,2026-01-25 09:00:00,late_interval_repair
chg_021_insert,21,INSERT,FR,plus,active,false,2026-06-01 10:00:00,2026-06-01 10:01:00,delete_closes_current
chg_021_delete,21,DELETE,FR,plus,active,false,2026-06-15 10:00:00,2026-06-15 10:01:00,delete_closes_current
chg_022_insert,22,INSERT,US,free,active,false,2026-03-01 09:00:00,2026-03-01 09:01:00,identical_values_distinct_ids
chg_022_noop,22,UPDATE,US,free,active,false,2026-03-08 09:00:00,2026-03-08 09:01:00,identical_values_distinct_ids
chg_022_real,22,UPDATE,CA,free,active,false,2026-03-15 09:00:00,2026-03-15 09:01:00,identical_values_distinct_ids
chg_042_insert,42,INSERT,US,free,active,false,2026-07-01 09:00:00,2026-07-01 09:05:00,customer_42_canonical
chg_042_upgrade,42,UPDATE,CA,premium,active,false,2026-07-10 14:00:00,2026-07-10 14:05:00,customer_42_canonical
chg_042_move,42,UPDATE,CA,free,active,false,2026-07-08 12:00:00,2026-07-11 08:00:00,customer_42_canonical
chg_042_move,42,UPDATE,CA,free,active,false,2026-07-08 12:00:00,2026-07-11 08:00:01,customer_42_canonical
chg_042_delete,42,DELETE,CA,premium,active,false,2026-07-20 18:00:00,2026-07-20 18:05:00,customer_42_canonical
"""

# Fixed expected result: the 42 versions of the scripted log in source order.
EXPECTED_HISTORY_CSV = """\
customer_id,source_change_id,valid_from,valid_to,row_current
1,chg_001_insert,2026-01-15 09:00:00,,true
2,chg_002_insert,2026-01-20 09:00:00,2026-03-01 10:00:00,false
2,chg_002_update,2026-03-01 10:00:00,,true
3,chg_003_insert,2026-02-01 09:00:00,2026-02-10 09:00:00,false
3,chg_003_update,2026-02-10 09:00:00,2026-02-20 09:00:00,false
10,chg_010_insert,2026-03-01 09:00:00,2026-03-05 12:00:00,false
10,chg_010_update,2026-03-05 12:00:00,,true
11,chg_011_insert,2026-03-10 09:00:00,2026-03-15 09:00:00,false
11,chg_011_update,2026-03-15 09:00:00,,true
12,chg_012_insert,2026-04-01 09:00:00,2026-04-10 09:00:00,false
12,chg_012_late,2026-04-10 09:00:00,2026-04-20 09:00:00,false
12,chg_012_later,2026-04-20 09:00:00,,true
13,chg_013_insert,2026-04-01 08:00:00,2026-04-04 08:00:00,false
13,chg_013_first,2026-04-04 08:00:00,2026-04-08 08:00:00,false
13,chg_013_second,2026-04-08 08:00:00,,true
14,chg_014_insert,2026-05-01 09:00:00,2026-05-10 09:00:00,false
14,chg_014_stale,2026-05-10 09:00:00,2026-05-20 09:00:00,false
14,chg_014_newer,2026-05-20 09:00:00,,true
15,chg_015_insert,2026-01-05 09:00:00,2026-01-12 09:00:00,false
15,chg_015_u1,2026-01-12 09:00:00,2026-01-20 09:00:00,false
15,chg_015_u2,2026-01-20 09:00:00,2026-02-01 09:00:00,false
15,chg_015_u3,2026-02-01 09:00:00,2026-02-15 09:00:00,false
15,chg_015_u4,2026-02-15 09:00:00,2026-03-01 09:00:00,false
15,chg_015_u5,2026-03-01 09:00:00,,true
16,chg_016_insert,2026-06-01 09:00:00,2026-06-08 09:00:00,false
16,chg_016_multi,2026-06-08 09:00:00,,true
17,chg_017_insert,2026-06-10 08:00:00,2026-06-10 16:30:00,false
17,chg_017_afternoon,2026-06-10 16:30:00,,true
18,chg_018_insert,2026-04-01 09:00:00,2026-04-15 12:00:00,false
18,chg_018_b,2026-04-15 12:00:00,,true
19,chg_019_insert,2026-05-01 09:00:00,2026-05-08 09:00:00,false
19,chg_019_update,2026-05-08 09:00:00,2026-05-12 09:00:00,false
20,chg_020_insert,2026-01-01 09:00:00,2026-01-10 09:00:00,false
20,chg_020_late,2026-01-10 09:00:00,2026-01-20 09:00:00,false
20,chg_020_later,2026-01-20 09:00:00,,true
21,chg_021_insert,2026-06-01 10:00:00,2026-06-15 10:00:00,false
22,chg_022_insert,2026-03-01 09:00:00,2026-03-08 09:00:00,false
22,chg_022_noop,2026-03-08 09:00:00,2026-03-15 09:00:00,false
22,chg_022_real,2026-03-15 09:00:00,,true
42,chg_042_insert,2026-07-01 09:00:00,2026-07-08 12:00:00,false
42,chg_042_move,2026-07-08 12:00:00,2026-07-10 14:00:00,false
42,chg_042_upgrade,2026-07-10 14:00:00,2026-07-20 18:00:00,false
"""

# Fixed expected result: customer 42 after the T1 cutoff 2026-07-10 23:59:59.
T1_CUTOFF = "2026-07-10 23:59:59"
EXPECTED_42_AFTER_T1 = [
    (42, "US", "free", "active", False, "2026-07-01 09:00:00", "2026-07-10 14:00:00", False, "chg_042_insert"),
    (42, "CA", "premium", "active", False, "2026-07-10 14:00:00", None, True, "chg_042_upgrade"),
]

# Fixed expected result: customer 42 full history with attributes.
EXPECTED_42 = [
    (42, "US", "free", "active", False, "2026-07-01 09:00:00", "2026-07-08 12:00:00", False, "chg_042_insert"),
    (42, "CA", "free", "active", False, "2026-07-08 12:00:00", "2026-07-10 14:00:00", False, "chg_042_move"),
    (42, "CA", "premium", "active", False, "2026-07-10 14:00:00", "2026-07-20 18:00:00", False, "chg_042_upgrade"),
]

# Fixed test events of customer 42 and their expected enrichment (None = unmatched).
EVENTS_42 = [
    ("evt_042_login", 42, "login", "2026-07-05 10:00:00"),
    ("evt_042_purchase", 42, "purchase", "2026-07-09 11:00:00"),
    ("evt_042_renewal", 42, "renewal", "2026-07-15 16:00:00"),
    ("evt_042_support", 42, "support_contact", "2026-07-25 09:00:00"),
]
EXPECTED_42_ENRICHED = {
    "evt_042_login": ("US", "free", "active", False, "chg_042_insert"),
    "evt_042_purchase": ("CA", "free", "active", False, "chg_042_move"),
    "evt_042_renewal": ("CA", "premium", "active", False, "chg_042_upgrade"),
    "evt_042_support": None,
}
