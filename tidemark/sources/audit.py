"""The audit log: one record per step, gathered while a run goes on and appended in one write."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import functions as F

from tidemark.schemas import AUDIT_SCHEMA, AUDIT_TABLE
from tidemark.sources.store import Store

STARTED, OK, ERROR = "STARTED", "OK", "ERROR"
MESSAGE_LENGTH = 250


def utc_now() -> dt.datetime:
    return dt.datetime.now(dt.UTC).replace(tzinfo=None)


class AuditLog:
    """Gathers records until ``flush``; as a context manager it flushes at the end, also after an error."""

    def __init__(self, store: Store, clock: Callable[[], dt.datetime] = utc_now):
        self.store = store
        self.now = clock
        self.records: list[tuple] = []

    def __enter__(self) -> AuditLog:
        return self

    def __exit__(self, *error: object) -> None:
        self.flush()

    def add(
        self, procedure: str, start: dt.datetime, status: str, message: str, rows: int | None = None,
        end: dt.datetime | None = None,
    ) -> None:
        end = end or self.now()
        seconds = Decimal((end - start) // dt.timedelta(microseconds=1)).scaleb(-6)
        self.records.append(
            (self.store.database, procedure, start, end, message[:MESSAGE_LENGTH], rows, status, seconds)
        )

    def started(self, procedure: str, message: str) -> dt.datetime:
        start = self.now()
        self.add(procedure, start, STARTED, message, end=start)
        return start

    def flush(self) -> int:
        """Appends what was gathered, numbered on from the last record of the log."""
        last = self.store.table(AUDIT_TABLE).agg(F.coalesce(F.max("order_id"), F.lit(0))).first()[0]
        rows = [(number, *record) for number, record in enumerate(self.records, last + 1)]
        self.store.append_rows(AUDIT_TABLE, rows, AUDIT_SCHEMA)
        self.records = []
        return len(rows)
