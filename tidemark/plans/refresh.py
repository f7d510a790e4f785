"""From history to dimensions, fact and mart."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.operators.labels import newest_order_labels
from tidemark.operators.latest import sales_fact
from tidemark.operators.parts import KeyRanges
from tidemark.operators.pit_join import RANGE, pit_join
from tidemark.operators.scd2 import scd2_ranges, with_current_flag
from tidemark.operators.upsert import append_missing, upsert
from tidemark.plans import messages as m
from tidemark.plans.mart import customer_cohorts, sales_mart
from tidemark.plans.together import together
from tidemark.schemas import (
    APPEND, BY_TARGET, COHORT_VIEW, CUSTOMER, DATE, FACT, MART_TABLE, MART_VIEW, PRODUCT, RESELLER, SALES,
    SALES_ORDER, SCD2, TERRITORY, TS, UPSERT, Entity,
)
from tidemark.sources.audit import ERROR, OK, AuditLog
from tidemark.sources.store import Store


def refresh_ranges(store: Store, entity: Entity, as_of: dt.date, full: bool) -> int:
    """New versions change the ranges of their own keys only: the other keys' rows are kept as they are, but for the
    current flag. Neither join reduces the keys to distinct ones, so that a hot key's rows can be split."""
    up_to = store.last_load(entity)
    included = 0 if full else store.included(entity.target)
    history = store.loads(entity, up_to)
    if included:
        touched = store.loads(entity, up_to, after=included).select(entity.key)
        ranged = scd2_ranges(history.join(touched, entity.key, "left_semi"), entity.key)
        kept = store.table(entity.target).join(touched, entity.key, "left_anti").drop("is_valid")
        ranged = kept.unionByName(ranged.withColumnsRenamed(dict(entity.renames)))
    else:
        ranged = scd2_ranges(history, entity.key).withColumnsRenamed(dict(entity.renames))
    return store.publish(entity.target, with_current_flag(ranged, as_of), entity.target_key, includes=up_to)


def append_rows(store: Store, entity: Entity, as_of: dt.date, full: bool) -> int:
    """The calendar grows by the days it lacks. It has one row per day, so writing it anew is cheap."""
    target = store.table(entity.target)
    before = target.count()
    up_to = store.last_load(entity)
    of_history = bool(store.included(entity.target)) or not before
    missing = append_missing(store.loads(entity, up_to), target, entity.key)
    return store.publish(
        entity.target, target.unionByName(missing), entity.target_key, includes=up_to if of_history else 0) - before


def upsert_labels(store: Store, entity: Entity, as_of: dt.date, full: bool) -> int:
    """Returns the rows that the newest valid labels of the whole history overwrite or add.

    While all rows of the table come from the history, only labels of new loads can change it, and that number is the
    table's. A table that held other rows is merged with the whole history each time, and the number is counted while
    the merged table is written.
    """
    up_to = store.last_load(entity)
    of_history = bool(store.included(entity.target)) or store.table(entity.target).isEmpty()
    included = 0 if full else store.included(entity.target)
    newest = newest_order_labels(store.loads(entity, up_to, after=included))
    ranges = line_ranges(store)
    if included and store.ranges(entity.target):
        only = parts_of_loads(store, entity, up_to, included, ranges)
        merged = upsert(store.parts_of(entity.target, only), newest, entity.key, newer=TS)
        return store.publish(
            entity.target, merged, entity.target_key, bucket_by=entity.key, includes=up_to, ranges=ranges, only=only)
    target = store.table(entity.target)
    if included:
        merged = upsert(target, newest, entity.key, newer=TS)
        return store.publish(
            entity.target, merged, entity.target_key, bucket_by=entity.key, includes=up_to, ranges=ranges)
    merged = upsert(target, newest, entity.key, hit="_hit")
    written = Observation()
    store.publish(
        entity.target, merged, entity.target_key, bucket_by=entity.key, observation=written, observed=F.col("_hit"),
        includes=up_to if of_history else 0, ranges=ranges,
    )
    return written.get["n"]


def line_ranges(store: Store) -> KeyRanges:
    """How the tables with one row per order line are cut: by the line keys the sales history began with."""
    return store.shared_ranges(SALES.key, store.table(SALES.history_table).select(SALES.key))


def parts_of_loads(store: Store, entity: Entity, up_to: int, after: int, ranges: KeyRanges) -> list[int]:
    """The parts that lines of some loads belong to; only the loads' keys are read."""
    return [r[0] for r in store.loads(entity, up_to, after=after).select(ranges.part()).distinct().collect()]


REFRESH: Mapping[str, Callable[[Store, Entity, dt.date, bool], int]] = {
    SCD2: refresh_ranges,
    APPEND: append_rows,
    UPSERT: upsert_labels,
}


def refresh_dim(store: Store, audit: AuditLog, name: str | None, as_of: dt.date, full: bool = False) -> str:
    """Refreshes the dimension of that name; returns the status. A failure leaves the dimension as it was.

    The result is always that of a rebuild from the whole history; ``full`` also makes it one.
    """
    begin = audit.started(m.REFRESH_DIMS, m.EXECUTION_STARTED.format(procedure=m.REFRESH_DIMS))
    start = audit.now()
    entity = BY_TARGET.get(name)
    status, message = OK, m.PROCEDURE_OK
    if entity is None or entity.kind == FACT:
        status, message = ERROR, m.UNSUPPORTED.format(table=m.NO_NAME if name is None else name)
        audit.add(m.REFRESH_DIMS, start, ERROR, message, 0)
    else:
        try:
            rows = REFRESH[entity.kind](store, entity, as_of, full)
            audit.add(m.REFRESH_DIMS, start, OK, m.UPLOADED.format(table=name), rows)
        except Exception as error:  # isolated like every stage
            status, message = ERROR, m.BRANCH_FAILED
            audit.add(m.REFRESH_DIMS, start, ERROR, m.UPLOAD_FAILED.format(error=error), 0)
    audit.add(m.REFRESH_DIMS, begin, status, message)
    return status


def refresh_fact(store: Store, audit: AuditLog, full: bool = False) -> str:
    """Brings the fact to the newest version of every line; returns the status.

    Only loads the fact does not include are read, reduced to their newest lines and merged into the parts of the fact
    that they touch: a join without a shuffle of the fact, which is bucketed by line key. The files of all other parts
    stay as they are. ``full`` rebuilds the fact from the whole history.
    """
    begin = audit.started(m.REFRESH_FACT, m.EXECUTION_STARTED.format(procedure=m.REFRESH_FACT))
    try:
        up_to = store.last_load(SALES)
        included = 0 if full else store.included(SALES.target)
        fact = sales_fact(store.loads(SALES, up_to, after=included))
        ranges, only = line_ranges(store), None
        if included:
            target = store.table(SALES.target)
            if store.ranges(SALES.target):
                only = parts_of_loads(store, SALES, up_to, included, ranges)
                target = store.parts_of(SALES.target, only)
            fact = upsert(target, fact, SALES.key, newer=TS)
        rows = store.publish(
            SALES.target, fact, SALES.target_key, bucket_by=SALES.key, includes=up_to, ranges=ranges, only=only)
        audit.add(m.REFRESH_FACT, begin, OK, m.PROCEDURE_OK, rows)
        return OK
    except Exception as error:  # isolated like every stage
        audit.add(m.REFRESH_FACT, begin, ERROR, f"{m.STEPS_FAILED}: {error}", 0)
        return ERROR


def refresh_changed(
    store: Store, audit: AuditLog, counts: Mapping[str, int], as_of: dt.date, min_changed: int = 2
) -> dict[str, str]:
    """Refreshes the targets with at least ``min_changed`` added rows; returns their statuses.

    A single changed row waits for the next larger change unless ``min_changed`` is 1. Records of targets with
    short names come first.
    """

    def refresh(log: AuditLog, target: str) -> str:
        return refresh_fact(store, log) if target == SALES.target else refresh_dim(store, log, target, as_of)

    by_name = sorted(counts, key=lambda name: (len(name), name))
    targets = [target for target in by_name if counts[target] >= min_changed]
    return dict(zip(targets, together(audit, refresh, targets)))


def live_mart(store: Store, lines: DataFrame | None = None, parts: Sequence[int] = ()) -> DataFrame:
    """The mart as the tables stand now, not stored: all of it, or that of some line keys, which lie in those parts.

    A line has to lie within the ranges of each dimension, so lines of days that no range of one covers are left out
    before any shuffle: here for the dimensions that grow, which are stored, as the mart does it for the small ones.
    """

    def of_lines(entity: Entity) -> DataFrame:
        if lines is None:
            return store.table(entity.target)
        rows = store.parts_of(entity.target, parts) if store.ranges(entity.target) else store.table(entity.target)
        return rows.join(lines, entity.key, "left_semi")

    fact = of_lines(SALES)
    for entity in (CUSTOMER, PRODUCT):
        first, last = (store.table(entity.target).agg(limit).scalar() for limit in (F.min(RANGE[0]), F.max(RANGE[1])))
        fact = fact.where(F.col("orderdatekey").between(first, last))
    return sales_mart(
        fact=fact,
        customer=store.table(CUSTOMER.target),
        product=store.table(PRODUCT.target),
        reseller=store.table(RESELLER.target),
        calendar=store.table(DATE.target),
        orders=of_lines(SALES_ORDER),
        territory=store.table(TERRITORY.target),
    )


def register_views(store: Store) -> None:
    """The live mart and the cohorts as temporary views for SQL users, defined anew whenever the store publishes."""

    def define() -> None:
        mart = live_mart(store)
        mart.createOrReplaceTempView(MART_VIEW)
        customer_cohorts(mart).createOrReplaceTempView(COHORT_VIEW)

    define()
    store.watchers.append(define)


SOURCES = (SALES, SALES_ORDER, DATE, CUSTOMER, PRODUCT, RESELLER, TERRITORY)


def changed_lines(store: Store, before: Mapping[str, int], now: Mapping[str, int]) -> DataFrame:
    """Keys of the lines whose mart rows may differ between two states of the mart's sources, with repeats.

    These are the lines that came with later loads of sales or labels, those of days that came into the calendar, and
    those whose order date lies in the range of a version that came into one of their dimensions. A new version takes
    its range from the version that held it before, so no other line changes. All changes are looked up in one pass
    over the fact.
    """
    changed = [e for e in SOURCES if now[e.target] > before[e.target]]

    def new(entity: Entity) -> DataFrame:
        return store.loads(entity, now[entity.target], after=before[entity.target])

    lines = [new(e).select(SALES.key) for e in changed if e in (SALES, SALES_ORDER)]
    keys = [SALES.key, "orderdatekey", *(e.key for e in changed if e.kind == SCD2)]
    fact = store.table(SALES.target).select(*keys)
    marks = []
    for entity in changed:
        mark = f"_new_{entity.target}"
        if entity.kind == SCD2:
            stamps = new(entity).select(entity.key, TS)
            versions = store.table(entity.target).join(stamps, [entity.key, TS], "left_semi")
            fact = pit_join(
                fact, versions.select(entity.key, *RANGE, F.lit(True).alias(mark)), entity.key, "orderdatekey", "left")
        elif entity is DATE:
            days = new(entity).select(F.col("date").alias("_day"), F.lit(True).alias(mark)).distinct()
            fact = fact.join(days, F.col("orderdatekey").cast("timestamp_ntz") == F.col("_day"), "left").drop("_day")
        else:
            continue
        marks.append(F.col(mark).isNotNull())
    if marks:
        lines.append(fact.where(reduce(lambda a, b: a | b, marks)).select(SALES.key))
    nothing = store.table(SALES.target).select(SALES.key).where(F.lit(False))
    return reduce(DataFrame.unionByName, lines, nothing)


def refresh_mart(store: Store, audit: AuditLog, full: bool = False) -> None:
    """Brings the stored mart up to date; a failure is recorded and raised.

    The mart notes which loads of its sources it was derived from. If it is known, for all of them, what has come
    since, only the lines touched by that are joined anew, and only the parts of the mart they lie in are replaced.
    Otherwise, or with ``full``, the whole mart is. The result is the same.

    Rows are sorted by date and region within each file, so that filters on them skip row groups.
    """
    start = audit.now()
    try:
        now = {e.target: store.included(e.target) for e in SOURCES}
        before = store.sources(MART_TABLE)
        ranges = store.ranges(MART_TABLE)
        known = all(before.get(target, 0) and now[target] >= before[target] for target in now)
        layout = {"sort_by": ("orderdatekey", "region_territory"), "sources": now if all(now.values()) else None}
        if full or not known or ranges is None:
            ranges = store.shared_ranges(SALES.key, store.table(SALES.target).select(SALES.key))
            store.publish(MART_TABLE, live_mart(store), [SALES.key], ranges=ranges, **layout)
        else:
            with store.kept_aside(changed_lines(store, before, now).distinct()) as touched:
                only = [r[0] for r in touched.select(ranges.part()).distinct().collect()]
                kept = store.parts_of(MART_TABLE, only).join(touched, SALES.key, "left_anti")
                mart = kept.unionByName(live_mart(store, touched, only))
                store.publish(MART_TABLE, mart, [SALES.key], ranges=ranges, only=only, **layout)
        audit.add(m.REFRESH_MART, start, OK, m.MART_OK)
    except Exception as error:
        audit.add(m.REFRESH_MART, start, ERROR, m.MART_FAILED.format(error=error))
        raise
