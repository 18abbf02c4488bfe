"""Identity of a run."""

from __future__ import annotations

import uuid
from datetime import UTC, datetime


def new_batch_id(source: str | None = None, execution_date: str | None = None) -> str:
    """A fresh batch id, or always the same one for a given source and date."""
    if source and execution_date:
        return str(uuid.uuid5(uuid.NAMESPACE_URL, f"{source}/{execution_date}"))
    return str(uuid.uuid4())


def utc_now() -> datetime:
    return datetime.now(UTC)


def today() -> str:
    return utc_now().strftime("%Y-%m-%d")
