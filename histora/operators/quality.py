"""Temporal data-quality checks (Q1-Q6) and table comparisons.

Every check returns the *violating rows*; zero rows means the check passes. ``validate`` runs several
checks as one Spark job and returns one row per check.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from histora.functions.exprs import FAR_FUTURE, entity_bucket, ts_literal
from histora.plans.ordered import chunked_running
from histora.session import work_path


_STEP = 100_000   # rows that one generated array stands for


def _repeat(df: DataFrame, times: Column) -> DataFrame:
    """Each row ``times`` times (``times`` >= 1): generators, no join, and no array longer than ``_STEP``-th parts."""
    n = times.cast("long")
    whole = F.sequence(F.lit(0).cast("long"), F.floor((n - 1) / (_STEP * _STEP)).cast("long"))
    out = df.withColumn("_n0", n).withColumn("_r0", F.explode(whole))
    left = F.least(F.col("_n0") - F.col("_r0") * (_STEP * _STEP), F.lit(_STEP * _STEP).cast("long"))
    out = out.withColumn("_n1", left).withColumn(
        "_r1", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n1") - 1) / _STEP).cast("long"))))
    last = F.least(F.col("_n1") - F.col("_r1") * _STEP, F.lit(_STEP).cast("long"))
    return (out.withColumn("_r2", F.explode(F.sequence(F.lit(1).cast("long"), last)))
            .drop("_n0", "_r0", "_n1", "_r1", "_r2"))


_WINDOW = ("valid_from", "_end", "_open", "m")     # a distinct window and its copies


def _written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once under the shared work folder and read back: its many readers do not compute it again."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _windows(df: DataFrame, entity_key: str, valid_from: str, valid_to: str) -> DataFrame:
    """Distinct windows with their copies ``m``; ``_end`` is the end or, of an open window, the far future."""
    base = df.select(F.col(entity_key).alias("entity_id"), F.col(valid_from).alias("valid_from"),
                     F.col(valid_to).alias("valid_to"))
    return (base.where(F.col("entity_id").isNotNull() & F.col("valid_from").isNotNull())
            .groupBy("entity_id", "valid_from", "valid_to").agg(F.count(F.lit(1)).alias("m"))
            .withColumn("_end", F.coalesce(F.col("valid_to"), ts_literal(FAR_FUTURE)))
            .withColumn("_open", F.col("valid_to").isNull()).drop("valid_to"))


def _regular_counts(reg: DataFrame) -> DataFrame:
    """For each regular window the number of other regular rows that overlap it, by two rank counts.

    ``#starts < end - #ends <= from - copies``: a regular window that ends by ``from`` also starts before ``end``.
    Both are running sums of one time-ordered union of the windows' ends (0), from-queries (1), end-queries (2) and
    starts (3) at equal times.
    """
    zero, own = F.lit(0).cast("long"), F.col("m")
    rows = [("_end", 0, zero, own), ("valid_from", 1, zero, zero), ("_end", 2, zero, zero), ("valid_from", 3, own, zero)]
    u = None
    for at, kind, starts, ends in rows:
        part = reg.select("entity_id", F.col(at).alias("_k"), F.lit(kind).alias("_o"), starts.alias("_ws"),
                          ends.alias("_we"), *_WINDOW)
        u = part if u is None else u.unionByName(part)
    run = chunked_running(u, ["entity_id"], ["_k", "_o"], {"_starts": F.col("_ws"), "_ends": F.col("_we")},
                          None, "sum", include_current=True)
    return (run.where(F.col("_o").isin(1, 2)).groupBy("entity_id", *_WINDOW)
            .agg(F.max(F.when(F.col("_o") == 2, F.col("_starts"))).alias("_starts"),
                 F.max(F.when(F.col("_o") == 1, F.col("_ends"))).alias("_ends"))
            .select("entity_id", *_WINDOW, (F.col("_starts") - F.col("_ends") - F.col("m")).alias("n")))


def _containment_counts(reg: DataFrame, inv: DataFrame) -> DataFrame:
    """For each regular window the inverted rows strictly inside it, and for each inverted one the rows around it.

    An inverted window [f, t], t <= f, overlaps the regular windows that start before t and end after f: a count of
    points that two lines dominate. It is done as divide and conquer over the rank of the start: a regular window
    is a point in one node a level (rank >> level), an inverted window asks for the first x ranks, x = starts before
    t, i.e. for the nodes of x's one bits; inside a node running sums over the ends tell, for a regular window, the
    inverted ones that start before its end, and for an inverted one the regular ones that end too early (taken
    from all that start early enough, which the ranking scan has counted). So n windows make n log n rows, whatever
    the number of pairs, and a hot entity's nodes are split like any hot key.
    """
    some = inv.select("entity_id").distinct()
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    starts = (reg.join(some, "entity_id", "left_semi")
              .select("entity_id", F.col("valid_from").alias("_t"), F.lit(1).alias("_o"), one.alias("_w"),
                      F.col("m").alias("_wm"), *_WINDOW))
    limits = inv.select("entity_id", F.col("_end").alias("_t"), F.lit(0).alias("_o"), zero.alias("_w"),
                        zero.alias("_wm"), *_WINDOW)
    ranked = _written(chunked_running(starts.unionByName(limits), ["entity_id"], ["_t", "_o", "_end", "_open"],
                                      {"_rank": F.col("_w"), "_mass": F.col("_wm")}, None, "sum"), "overlap-ranks")
    asked = ranked.where((F.col("_o") == 0) & (F.col("_rank") > 0))
    caps = asked.groupBy("entity_id").agg(F.max("_rank").alias("_cap"))
    bits = "length(bin({0})) - 1"
    points = (ranked.where(F.col("_o") == 1).join(caps, "entity_id").where("_rank < _cap")
              .withColumn("_level", F.explode(F.expr(f"sequence(0, {bits.format('_cap')})")))
              .select("entity_id", "_level", F.expr("shiftright(_rank, _level)").alias("_node"),
                      F.col("_end").alias("_t"), F.lit(0).alias("_o"), F.col("m").alias("_wp"), zero.alias("_wq"),
                      zero.alias("_mass"), *_WINDOW))
    queries = (asked.withColumn("_level", F.explode(F.expr(
                   f"filter(sequence(0, {bits.format('_rank')}), k -> shiftright(_rank, k) & 1 = 1)")))
               .select("entity_id", "_level", F.expr("shiftright(_rank, _level) - 1").alias("_node"),
                       F.col("valid_from").alias("_t"), F.lit(1).alias("_o"), zero.alias("_wp"),
                       F.col("m").alias("_wq"), "_mass", *_WINDOW))
    # at equal times points come first: they end by the query's time, and it is not before their end
    run = chunked_running(points.unionByName(queries), ["entity_id", "_level", "_node"], ["_t", "_o"],
                          {"_inside": F.col("_wq"), "_early": F.col("_wp")}, None, "sum", include_current=True)
    return run.groupBy("entity_id", *_WINDOW).agg(
        (F.max("_mass") + F.sum(F.when(F.col("_o") == 0, F.col("_inside")).otherwise(-F.col("_early")))).alias("n"))


def overlap_counts(df: DataFrame, entity_key: str = "customer_id", valid_from: str = "valid_from",
                   valid_to: str = "valid_to") -> DataFrame:
    """Every distinct window that overlaps another row's: ``entity_id, valid_from, valid_to, copies, n_overlaps``.

    ``n_overlaps`` is the number of other rows that one row of the window overlaps. With ``end`` = valid_to or far
    future, rows a and b overlap iff ``b.from < a.end and a.from < b.end``; rows with identical bounds do not (S14),
    nor do two inverted windows. There is no pair anywhere: regular windows count each other by rank
    (:func:`_regular_counts`), inverted and regular ones by dominance counting (:func:`_containment_counts`), so the
    work is n log n on an entity of n windows, hot or not. The distinct windows are written once when this is called;
    a history without inverted ones has only the rank counts to make. Rows without an entity or a start overlap nothing.
    """
    wins = _written(_windows(df, entity_key, valid_from, valid_to), "overlap-windows")
    reg, inv = wins.where(F.col("valid_from") < F.col("_end")), wins.where(F.col("valid_from") >= F.col("_end"))
    found = _regular_counts(reg)
    if not inv.isEmpty():
        found = found.unionByName(_containment_counts(reg, inv))
    return (found.groupBy("entity_id", *_WINDOW).agg(F.sum("n").alias("n_overlaps")).where("n_overlaps > 0")
            .select("entity_id", "valid_from", F.when(~F.col("_open"), F.col("_end")).alias("valid_to"),
                    F.col("m").alias("copies"), "n_overlaps"))


def overlap_violations(df: DataFrame, entity_key: str = "customer_id", valid_from: str = "valid_from",
                       valid_to: str = "valid_to") -> DataFrame:
    """Q1: inverted/zero-width closed windows, and windows overlapping another of the same entity.

    Output ``entity_id, valid_from, valid_to, failure_kind``, with the reference's pair semantics: an
    overlapping row is reported once per *other* row it overlaps (so each pair twice, once per side); an inverted
    row is reported as inverted, and again as ``overlap`` for every window that strictly contains it. The numbers
    come from :func:`overlap_counts`; only at the end are rows repeated by them, for this output.
    """
    base = df.select(F.col(entity_key).alias("entity_id"), F.col(valid_from).alias("valid_from"),
                     F.col(valid_to).alias("valid_to"))
    inverted = base.where(F.col("valid_to").isNotNull() & (F.col("valid_from") >= F.col("valid_to"))
                          ).withColumn("failure_kind", F.lit("inverted_or_zero_width"))
    counts = overlap_counts(df, entity_key, valid_from, valid_to)
    rows = _repeat(counts, F.col("copies") * F.col("n_overlaps"))
    return inverted.unionByName(rows.select("entity_id", "valid_from", "valid_to", F.lit("overlap").alias("failure_kind")))


def current_record_violations(df: DataFrame, entity_key: str = "customer_id",
                              current_flag: str = "row_current", valid_to: str = "valid_to") -> DataFrame:
    """Q2: a live entity (an open window exists) has exactly one current row, a deleted one none."""
    per_entity = df.groupBy(F.col(entity_key).alias("entity_id")).agg(
        F.count_if(F.col(current_flag)).alias("current_rows"),
        F.count_if(F.col(valid_to).isNull()).alias("open_rows"))
    expected = F.when(F.col("open_rows") == 0, 0).otherwise(1)
    return per_entity.where(F.col("current_rows") != expected)


def interval_order_violations(df: DataFrame, entity_key: str = "customer_id") -> DataFrame:
    """Q3: every closed window must satisfy ``valid_from < valid_to``."""
    return df.where(F.col("valid_to").isNotNull() & (F.col("valid_from") >= F.col("valid_to"))).select(
        entity_key, "source_change_id", "valid_from", "valid_to")


def not_null_violations(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Q4: one row per (row, NULL column) among ``columns``, with the ``keep`` columns to find the row.

    One pass over the table for any number of columns.
    """
    names = F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in columns])
    return df.select(*keep, F.explode(F.array_compact(names)).alias("column_name"))


def unique_violations(df: DataFrame, column: str) -> DataFrame:
    """Q5: non-NULL values of ``column`` that occur more than once (``unique_field, n_records``)."""
    return (df.where(F.col(column).isNotNull())
            .groupBy(F.col(column).alias("unique_field"))
            .agg(F.count(F.lit(1)).alias("n_records"))
            .where(F.col("n_records") > 1))


def accepted_values_violations(df: DataFrame, column: str, values: Iterable) -> DataFrame:
    """Q6: values of ``column`` outside ``values`` with their row counts (NULL passes)."""
    return (df.groupBy(F.col(column).alias("value_field"))
            .agg(F.count(F.lit(1)).alias("n_records"))
            .where(~F.col("value_field").isin(list(values))))


def table_diff(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Multiset difference in both directions; empty means the tables are equal on ``columns``.

    One tagged union and one aggregate over all columns (NULLs group together, as in ``EXCEPT ALL``):
    a single shuffle with map-side partial counts, instead of two ``exceptAll`` plans over both inputs.
    A row that is k times more often on one side is returned k times with that side.
    """
    tagged = (left.select(*columns, F.lit(1).alias("_l"), F.lit(0).alias("_r"))
              .unionByName(right.select(*columns, F.lit(0).alias("_l"), F.lit(1).alias("_r"))))
    counts = tagged.groupBy(*columns).agg(F.sum("_l").alias("_nl"), F.sum("_r").alias("_nr"))
    diff = (counts.where(F.col("_nl") != F.col("_nr"))
            .withColumn("diff_side", F.when(F.col("_nl") > F.col("_nr"), "left_only").otherwise("right_only"))
            .withColumn("_k", F.abs(F.col("_nl") - F.col("_nr"))))
    return _repeat(diff, F.col("_k")).select(*columns, "diff_side")


def fingerprints(df: DataFrame, columns: Sequence[str], key: str, buckets: int = 1024) -> DataFrame:
    """(bucket, n, a, b): rows and two wide sums of row hashes of each hash bucket of ``key``.

    A sum does not depend on the order of the rows and follows their multiplicity, so equal multisets have equal
    fingerprints; unequal ones agree by chance with probability about 2**-128 a bucket. One map-side aggregate, one row
    a bucket and task to shuffle. A NULL hashes unlike any value, whatever its column.
    """
    parts = [x for c in columns for x in (F.col(c).isNull(), F.col(c))]
    wide = lambda seed: F.sum(F.xxhash64(F.lit(seed), *parts).cast("decimal(20,0)"))
    return df.groupBy(entity_bucket(key, buckets).alias("bucket")).agg(
        F.count(F.lit(1)).alias("n"), wide(1).alias("a"), wide(2).alias("b"))


def unequal_buckets(left: DataFrame, right: DataFrame, columns: Sequence[str], key: str, buckets: int = 1024) -> list[int]:
    """The buckets of ``key`` in which the two tables differ as multisets; an empty list if they are equal."""
    one, other = (fingerprints(t, columns, key, buckets) for t in (left, right))
    same = F.lit(True)
    for c in ("n", "a", "b"):
        same = same & one[c].eqNullSafe(other[c])
    found = one.join(other, one["bucket"] == other["bucket"], "full").where(~same)
    return sorted(r[0] for r in found.select(F.coalesce(one["bucket"], other["bucket"])).collect())


def table_diff_by_bucket(left: DataFrame, right: DataFrame, columns: Sequence[str], key: str,
                         buckets: int = 1024) -> DataFrame:
    """:func:`table_diff` of the rows of unequal buckets only: tables that agree, or nearly do, are read but not
    shuffled, apart from ``buckets`` fingerprints a task."""
    differ = unequal_buckets(left, right, columns, key, buckets)
    some = entity_bucket(key, buckets).isin(differ)
    return table_diff(left.where(some), right.where(some), columns)


def missing_scenarios(catalog: DataFrame, log: DataFrame, tag_column: str = "scenario_tag",
                      catalog_column: str = "tag", entity_column: str | None = None) -> DataFrame:
    """Catalogue entries that never occur in the log.

    With ``entity_column`` (of both) an entry names the entity too, and occurs only if that entity has the tag.
    """
    on = [catalog_column, *([entity_column] if entity_column else [])]
    seen = log.select(F.col(tag_column).alias(catalog_column), *on[1:]).distinct()
    return catalog.join(seen, on, "left_anti")


def validate(checks: Mapping[str, DataFrame]) -> DataFrame:
    """Run named checks as one job: ``check_name, violations, passed`` per check."""
    parts = [df.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(name).alias("check_name"), "violations")
             for name, df in checks.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("passed", F.col("violations") == 0)


def dimension_checks(dim: DataFrame, entity_key: str = "customer_id",
                     version_id: str = "customer_version_id") -> dict[str, DataFrame]:
    """The declared tests of a Type 2 dimension (as applied to the customer dimension)."""
    return {
        "no_overlapping_validity_windows": overlap_violations(dim, entity_key),
        "exactly_one_current_record": current_record_violations(dim, entity_key),
        "closed_intervals_ordered": interval_order_violations(dim, entity_key),
        "not_null": not_null_violations(dim, [version_id, entity_key, "valid_from", "row_current",
                                              "source_change_id"], keep=[version_id]),
        "unique_version_id": unique_violations(dim, version_id),
    }


# The declared tests of every layer (column lists of the change-log data model).
STAGING_NOT_NULL = ("received_id", "change_id", "customer_id", "operation", "source_updated_at", "ingested_at")
EVENTS_NOT_NULL = ("event_id", "customer_id", "event_timestamp")
CHANGES_NOT_NULL = ("change_id", "customer_id")
SEQUENCE_NOT_NULL = ("change_id", "change_seq")
DIMENSION_NOT_NULL = ("customer_version_id", "customer_id", "valid_from", "row_current", "source_change_id")
SERVING_NOT_NULL = ("event_id", "customer_id", "event_timestamp", "matched_historical_state")
ACCEPTED_OPERATIONS = ("INSERT", "UPDATE", "DELETE")


def declared_check_list() -> list[tuple[str, str, str, str]]:
    """(check name, layer, kind, column) of every declared test, in a fixed order."""
    out = []
    for layer, kind, cols in (("staging", "not_null", STAGING_NOT_NULL), ("staging", "unique", ("received_id",)),
                              ("staging", "accepted_values", ("operation",)),
                              ("events", "not_null", EVENTS_NOT_NULL), ("events", "unique", ("event_id",)),
                              ("changes", "not_null", CHANGES_NOT_NULL), ("changes", "unique", ("change_id",)),
                              ("sequence", "not_null", SEQUENCE_NOT_NULL), ("sequence", "unique", ("change_id",)),
                              ("dimension", "not_null", DIMENSION_NOT_NULL),
                              ("dimension", "unique", ("customer_version_id",)),
                              ("dimension", "no_overlapping_validity_windows", ("",)),
                              ("dimension", "exactly_one_current_record", ("",)),
                              ("dimension", "closed_intervals_ordered", ("",)),
                              ("facts", "not_null", EVENTS_NOT_NULL), ("facts", "unique", ("event_id",)),
                              ("serving", "not_null", SERVING_NOT_NULL), ("serving", "unique", ("event_id",))):
        for c in cols:
            out.append((f"{layer}.{kind}" + (f".{c}" if c else ""), layer, kind, c))
    return out


def declared_checks(layers: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Violating rows of every declared test; ``layers`` maps staging/events/changes/sequence/dimension/
    facts/serving to their DataFrames. Run them together with :func:`validate`."""
    checks = {}
    for name, layer, kind, col in declared_check_list():
        df = layers[layer]
        if kind == "not_null":
            checks[name] = not_null_violations(df, [col])
        elif kind == "unique":
            checks[name] = unique_violations(df, col)
        elif kind == "accepted_values":
            checks[name] = accepted_values_violations(df, col, ACCEPTED_OPERATIONS)
        elif kind == "no_overlapping_validity_windows":
            checks[name] = overlap_violations(df)
        elif kind == "exactly_one_current_record":
            checks[name] = current_record_violations(df)
        else:
            checks[name] = interval_order_violations(df)
    return checks


def validate_declared(layers: Mapping[str, DataFrame]) -> DataFrame:
    """``validate(declared_checks(layers))`` with a smaller plan: the not-null tests of a layer share one
    aggregate pass (one row of NULL counts, unpivoted), the other tests count their violating rows."""
    listing = declared_check_list()
    parts = []
    for layer, df in layers.items():
        cols = [c for _, lay, kind, c in listing if lay == layer and kind == "not_null"]
        if cols:
            counts = df.agg(*[F.sum(F.col(c).isNull().cast("long")).alias(f"_nn{i}") for i, c in enumerate(cols)])
            rows = F.array(*[F.struct(F.lit(f"{layer}.not_null.{c}").alias("check_name"),
                                      F.coalesce(F.col(f"_nn{i}"), F.lit(0).cast("long")).alias("violations"))
                             for i, c in enumerate(cols)])
            parts.append(counts.select(F.explode(rows).alias("_x")).select("_x.*"))
    others = {n: df for n, df in declared_checks(layers).items() if ".not_null." not in n}
    out = validate(others).drop("passed")
    for p in parts:
        out = out.unionByName(p)
    return out.withColumn("passed", F.col("violations") == 0)
