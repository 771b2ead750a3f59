"""Task parameters of the session, page and area programs.

An empty or missing value means "no restriction", as in the original task JSON where an
empty string switches a predicate off. Ages are a range that is active only when both
bounds are given.
"""

from __future__ import annotations

from dataclasses import dataclass, field


def _as_list(value) -> list[str]:
    if value is None:
        return []
    if isinstance(value, str):
        return [v for v in value.split(",") if v != ""]
    return [str(v) for v in value if v is not None and str(v) != ""]


@dataclass(frozen=True)
class TaskParams:
    start_date: str = "2024-01-01"
    end_date: str = "2024-01-30"
    start_age: int | None = None
    end_age: int | None = None
    professionals: tuple[str, ...] = field(default_factory=tuple)
    cities: tuple[str, ...] = field(default_factory=tuple)
    sex: str | None = None
    keywords: tuple[str, ...] = field(default_factory=tuple)
    category_ids: tuple[str, ...] = field(default_factory=tuple)
    target_page_flow: tuple[int, ...] = (1, 2, 3, 4, 5, 6, 7)

    @staticmethod
    def from_json(text: str) -> "TaskParams":
        """Build from the original task-parameter JSON text."""
        import json
        return TaskParams.from_dict(json.loads(text))

    @staticmethod
    def from_dict(d: dict) -> "TaskParams":
        """Build from the original JSON keys (startDate, endDate, startAge, ...)."""

        def num(v):
            return None if v in (None, "") else int(v)

        flow = d.get("targetPageFlow") or ""
        return TaskParams(
            start_date=d["startDate"],
            end_date=d["endDate"],
            start_age=num(d.get("startAge")),
            end_age=num(d.get("endAge")),
            professionals=tuple(_as_list(d.get("professionals"))),
            cities=tuple(_as_list(d.get("cities"))),
            sex=(d.get("sex") or None),
            keywords=tuple(_as_list(d.get("keywords"))),
            category_ids=tuple(_as_list(d.get("categoryIds"))),
            target_page_flow=tuple(int(p) for p in _as_list(flow)),
        )


# The two parameter sets used by the fixtures (FIXTURES.md section 6).
DEFAULT_PARAMS = TaskParams(start_age=20, end_age=50)
KEYWORD_PARAMS = TaskParams(
    start_age=20,
    end_age=50,
    sex="male",
    keywords=("kw1", "kw2"),
    category_ids=("3", "4", "5", "6", "7", "8", "9"),
)
# Professions and cities: every second one of the generated users.
PROFILE_PARAMS = TaskParams(professionals=tuple(f"professional{i}" for i in range(0, 100, 2)),
                            cities=tuple(f"city{i}" for i in range(1, 25, 2)))
DEFAULT_TASK_ID = "task-0"
