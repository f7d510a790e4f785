"""One full load: sheets to staging, staging to history, history to dimensions and fact, and the mart."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from tidemark.operators.changes import ANY
from tidemark.plans import messages as m
from tidemark.plans.refresh import refresh_changed, refresh_mart
from tidemark.plans.upload import upload_src
from tidemark.schemas import SHEET_ORDER
from tidemark.sources.audit import ERROR, OK, AuditLog
from tidemark.sources.rejects import read_checked
from tidemark.sources.sheets import normalize_columns, read_sheet, stamp
from tidemark.sources.store import Store

Sheet = DataFrame | tuple[str, str] | tuple[str, str, Mapping[str, object]]


@dataclass
class Run:
    status: str = OK
    rows_loaded: int = 0
    counts: dict[str, int] = field(default_factory=dict)
    refreshed: dict[str, str] = field(default_factory=dict)
    mart_status: str = OK


def run(
    store: Store,
    sheets: Mapping[str, Sheet],
    load_ts: dt.datetime,
    as_of: dt.date | None = None,
    min_changed: int = 2,
    audit: AuditLog | None = None,
    against: str = ANY,
    rejects: bool = False,
) -> Run:
    """Loads all sheets, each a DataFrame or a path, its format and perhaps reader options, and brings the warehouse up to date.

    A sheet that cannot be staged is recorded, the other sheets are still staged, and nothing is uploaded. A sheet
    that is not there ends the run. ``against`` is that of change capture. The mart is refreshed in any case, and its status kept apart.

    With ``rejects`` bad rows of CSV sheets that are given by path do not fail their sheet: they are kept beside the
    staging table, in one of its name and ``_rejected``, and the audit has their number.
    """
    audit = audit or AuditLog(store)
    result = Run()
    begin = audit.now()
    try:
        staged = _stage_sheets(store, audit, sheets, load_ts, result, begin, rejects)
        audit.flush()  # a long run can be followed, and what was done is on record should the driver be lost
        if result.status == OK:
            _upload_and_refresh(store, audit, staged, as_of or load_ts.date(), min_changed, result, against)
            audit.flush()
        start = audit.now()
        procedure = f"{store.database}.{m.REFRESH_MART}"
        try:
            refresh_mart(store, audit)
            audit.add(procedure, start, OK, m.MART_COMPLETED)
        except Exception as error:  # the mart is separate from the load
            result.mart_status = ERROR
            audit.add(procedure, start, ERROR, m.MART_PROCEDURE_FAILED.format(error=error))
        message = m.FULL_RUN_OK if result.status == OK else m.FULL_RUN_FAILED
        audit.add(m.FULL_RUN, begin, result.status, message, result.rows_loaded)
    finally:
        audit.flush()
    return result


def _stage_sheets(
    store: Store, audit: AuditLog, sheets: Mapping[str, Sheet], load_ts: dt.datetime, result: Run, begin: dt.datetime,
    rejects: bool,
) -> dict[str, int]:
    staged: dict[str, int] = {}
    for entity in SHEET_ORDER:
        sheet = sheets[entity.sheet]
        rejected = None
        if isinstance(sheet, DataFrame):
            df = sheet
        elif rejects and sheet[1] == "csv":
            checked = read_checked(store.spark, sheet[0], entity.schema, **dict(*sheet[2:]))
            df, rejected = checked.accepted, checked.rejected
        else:
            df = read_sheet(store.spark, *sheet[:2], **dict(*sheet[2:]))
        table = entity.staging_table
        start = audit.now()
        try:
            if rejected is not None:
                aside = f"{table}_rejected"
                rows = store.stage(aside, rejected)
                audit.add(m.REJECT.format(table=table), start, OK, m.REJECTED.format(rows=rows, rejected=aside), rows)
            staged[table] = store.stage(table, stamp(normalize_columns(df), load_ts))
            result.rows_loaded += staged[table]
            audit.add(m.LOAD.format(table=table), start, OK, m.LOADED.format(table=table), staged[table])
        except Exception as error:  # the other sheets are still staged
            result.status = ERROR
            audit.add(m.LOAD.format(table=table), start, ERROR, m.LOAD_FAILED.format(table=table, error=error), 0)
    message = m.ALL_SHEETS_OK if result.status == OK else m.ALL_SHEETS_FAILED
    audit.add(m.ALL_SHEETS, begin, result.status, message, result.rows_loaded)
    return staged


def _upload_and_refresh(
    store: Store, audit: AuditLog, staged: Mapping[str, int], as_of: dt.date, min_changed: int, result: Run, against: str
) -> None:
    start = audit.now()
    upload = upload_src(store, audit, staged, against)
    result.status, result.counts = upload.status, upload.counts
    message = m.UPLOAD_COMPLETED if upload.status == OK else m.UPLOAD_PROCEDURE_FAILED.format(error=m.PHASES_FAILED)
    audit.add(m.UPLOAD, start, upload.status, message)
    result.refreshed = refresh_changed(store, audit, upload.counts, as_of, min_changed)
