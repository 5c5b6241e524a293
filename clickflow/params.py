"""Task parameters: the query interface of every job.

An unset (``None``) or empty parameter means "no restriction". List parameters are
comma-separated text, as the task description supplies them.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, fields, replace


def split_list(text: str | None) -> list[str] | None:
    """Comma list → items; ``None`` when the parameter is unset or empty."""
    if text is None or text.strip() == "":
        return None
    return [item.strip() for item in text.split(",") if item.strip() != ""]


@dataclass(frozen=True)
class TaskParams:
    start_date: str = "2024-01-01"
    end_date: str = "2024-01-30"
    start_age: int | None = 20
    end_age: int | None = 50
    professionals: str | None = None
    cities: str | None = None
    sex: str | None = None
    keywords: str | None = None
    category_ids: str | None = None
    target_page_flow: str = "1,2,3,4,5,6,7"
    task_id: str = "task-default"
    # Ad statistics: a user is blacklisted once a (day, user, ad) count exceeds this.
    ad_click_threshold: int = 10
    # Sampling (declared output of the session job): sessions to draw over all hours.
    sample_size: int = 100

    def with_(self, **changes) -> "TaskParams":
        return replace(self, **changes)

    @property
    def page_flow(self) -> list[int]:
        items = split_list(self.target_page_flow) or []
        return [int(x) for x in items]

    @property
    def page_pairs(self) -> list[tuple[int, int, int]]:
        """(position, from page, to page) for each adjacent pair of the target flow."""
        flow = self.page_flow
        return [(i + 1, a, b) for i, (a, b) in enumerate(zip(flow, flow[1:]))]


# The keys of the task-parameter JSON and the field each one sets.
JSON_KEYS = {
    "startDate": "start_date",
    "endDate": "end_date",
    "startAge": "start_age",
    "endAge": "end_age",
    "professionals": "professionals",
    "cities": "cities",
    "sex": "sex",
    "keywords": "keywords",
    "categoryIds": "category_ids",
    "targetPageFlow": "target_page_flow",
}


def params_from_json(text: str, base: TaskParams | None = None) -> TaskParams:
    """Task parameters from the JSON object of the task description. Keys that are
    absent keep the ``base`` value; empty text means "no restriction"."""
    raw = json.loads(text)
    changes = {}
    for key, field_name in JSON_KEYS.items():
        if key not in raw:
            continue
        value = raw[key]
        if isinstance(value, list):  # some writers give lists as arrays
            value = ",".join(str(v) for v in value)
        if value is None or str(value).strip() == "":
            value = None
        elif field_name in ("start_age", "end_age"):
            value = int(value)
        else:
            value = str(value)
        if value is not None or field_name not in ("start_date", "end_date", "target_page_flow"):
            changes[field_name] = value
    for f in fields(TaskParams):  # our own field names (task_id, thresholds) too
        if f.name in raw and f.name not in JSON_KEYS:
            changes[f.name] = raw[f.name]
    return replace(base or TaskParams(), **changes)


DEFAULT_PARAMS = TaskParams()
