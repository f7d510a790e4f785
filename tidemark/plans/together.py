"""Independent steps side by side: small entities fill the gaps that a large one leaves on the cluster."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from tidemark.sources.audit import AuditLog


def together[Item, Result](
    audit: AuditLog, step: Callable[[AuditLog, Item], Result], items: Iterable[Item]
) -> list[Result]:
    """Results of ``step`` for all items, in their order; so are the audit records each step leaves."""
    items = list(items)
    logs = [AuditLog(audit.store, audit.now) for _ in items]
    if not items:
        return []
    with ThreadPoolExecutor(len(items)) as pool:
        results = list(pool.map(step, logs, items))
    for log in logs:
        audit.records += log.records
    return results
