"""Job parameters (P15): typed conditions instead of SQL text built from
strings (K16).  Accepts the lenient JSON form with unquoted keys."""

from __future__ import annotations

import dataclasses
import json
import re

from shoplens.functions import constants as K

# A quoted string (kept as it is), or a bare key before its colon.
_STRING_OR_KEY = re.compile(r'("(?:[^"\\]|\\.)*")|([A-Za-z_][A-Za-z0-9_]*)(?=\s*:)')


def parse_lenient_json(text: str) -> dict:
    """``{startDate:"2019-11-01", ...}`` -> dict (keys may be unquoted; a
    properties-file line continuation ``\\`` + newline is tolerated)."""
    text = re.sub(r"\\\s*\n", " ", text.strip())
    if "=" in text.split("{", 1)[0]:
        text = text.split("=", 1)[1]
    return json.loads(_STRING_OR_KEY.sub(lambda m: m.group(1) or f'"{m.group(2)}"', text))


def _blank(v):
    return None if v is None or str(v).strip() == "" else str(v).strip()


@dataclasses.dataclass(frozen=True)
class Conditions:
    """Filter conditions of the category jobs.  ``None`` = no filter on that
    end.  Keys that the jobs never read (professionals, city, gender,
    keywords, categoryIds) are kept for callers but filter nothing."""

    start_date: str | None = None
    end_date: str | None = None
    start_age: str | None = None
    end_age: str | None = None
    target_page_flow: str = K.DEFAULT_PAGE_FLOW
    extra: dict = dataclasses.field(default_factory=dict)

    @property
    def start_age_int(self):
        return None if self.start_age is None else int(self.start_age)

    @property
    def end_age_int(self):
        return None if self.end_age is None else int(self.end_age)

    @property
    def page_flow(self) -> list[str]:
        return [p.strip() for p in self.target_page_flow.split(",") if p.strip()]

    @classmethod
    def from_dict(cls, d: dict) -> "Conditions":
        known = {"startDate", "endDate", "startAge", "endAge", "targetPageFlow"}
        return cls(
            start_date=_blank(d.get("startDate")),
            end_date=_blank(d.get("endDate")),
            start_age=_blank(d.get("startAge")),
            end_age=_blank(d.get("endAge")),
            target_page_flow=_blank(d.get("targetPageFlow")) or K.DEFAULT_PAGE_FLOW,
            extra={k: v for k, v in d.items() if k not in known},
        )

    @classmethod
    def from_json(cls, text: str) -> "Conditions":
        return cls.from_dict(parse_lenient_json(text))


DEFAULT = Conditions.from_dict(K.DEFAULT_CONDITIONS)
# Conditions used against the test tables (their events span January 2024).
TEST = Conditions(start_date="2024-01-03", end_date="2024-01-28", start_age="20", end_age="50")
