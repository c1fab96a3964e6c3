from __future__ import annotations

import csv
import io
from datetime import datetime

from pyspark.sql import functions as F

from histora.spec import CDC_SCHEMA

TS = "%Y-%m-%d %H:%M:%S"


def ts(text):
    return None if text in (None, "") else datetime.strptime(text, TS)


def log_df(spark, rows):
    """Change-log rows as tuples in CDC_SCHEMA order (timestamps as text)."""
    conv = [(c, cid, op, cc, tier, st, ev, ts(src), ts(ing), tag)
            for (c, cid, op, cc, tier, st, ev, src, ing, tag) in rows]
    return spark.createDataFrame(conv, CDC_SCHEMA)


def rows_of(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def expected_history():
    from tests.fixtures_data import EXPECTED_HISTORY_CSV
    out = []
    for r in csv.DictReader(io.StringIO(EXPECTED_HISTORY_CSV)):
        out.append((int(r["customer_id"]), r["source_change_id"], ts(r["valid_from"]), ts(r["valid_to"]),
                    r["row_current"] == "true"))
    return sorted(out)


def intervals(df, entity):
    return [(r.customer_id, r.country_code, r.subscription_tier, r.account_status, r.email_verified,
             r.valid_from.strftime(TS), r.valid_to.strftime(TS) if r.valid_to else None, r.row_current,
             r.source_change_id)
            for r in df.where(F.col("customer_id") == entity).orderBy("valid_from", "source_change_id").collect()]
