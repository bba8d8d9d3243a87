"""Parameters of a task: date range, session filters and target page flow."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass


def _text(value) -> str | None:
    value = "" if value is None else str(value).strip()
    return value or None


def _items(value) -> tuple[str, ...]:
    """A comma list, or a Python list, as a tuple without empty items."""
    if value is None:
        return ()
    pieces = value.split(",") if isinstance(value, str) else value
    return tuple(text for piece in pieces if (text := _text(piece)))


def _number(value) -> int | None:
    text = _text(value)
    return None if text is None else int(text)


def _day(value) -> dt.date:
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(value)


@dataclass(frozen=True)
class TaskParams:
    """An unset parameter (None or empty) switches its filter off."""

    start_date: dt.date
    end_date: dt.date
    start_age: int | None = None
    end_age: int | None = None
    professionals: tuple[str, ...] = ()
    cities: tuple[str, ...] = ()
    sex: str | None = None
    keywords: tuple[str, ...] = ()
    category_ids: tuple[int, ...] = ()
    target_page_flow: tuple[int, ...] = ()

    @classmethod
    def from_dict(cls, values: Mapping) -> TaskParams:
        """Read the job parameter names, e.g. ``{"startDate": "2024-01-05", ...}``."""
        return cls(
            start_date=_day(values["startDate"]),
            end_date=_day(values["endDate"]),
            start_age=_number(values.get("startAge")),
            end_age=_number(values.get("endAge")),
            professionals=_items(values.get("professionals")),
            cities=_items(values.get("cities")),
            sex=_text(values.get("sex")),
            keywords=_items(values.get("keywords")),
            category_ids=tuple(int(c) for c in _items(values.get("categoryIds"))),
            target_page_flow=tuple(int(p) for p in _items(values.get("targetPageFlow"))),
        )
