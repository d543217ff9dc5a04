"""The curation pipeline as a stage graph: inclusive ranges with fractional stages, status files, strict runs."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from decimal import Decimal
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sinks.records import write_status

DEFAULT_RANGE = ("11", "14")


@dataclass(frozen=True)
class Stage:
    """A numbered step: run(config) gives (total, errors)."""

    id: str
    name: str
    run: Callable[[dict], tuple[int, list[dict]]]


@dataclass
class Settings:
    """A pipeline's configuration: a section a stage, and what all share."""

    sections: dict[str, dict[str, Any]] = field(default_factory=dict)
    shared: dict[str, Any] = field(default_factory=dict)

    @classmethod
    def load(cls, path: str) -> Settings:
        """From JSON or, where a YAML library is installed, YAML; `shared` is its own section."""
        import json
        from pathlib import Path

        text = Path(path).read_text(encoding="utf-8")
        if path.endswith((".yaml", ".yml")):
            import yaml

            raw = yaml.safe_load(text) or {}
        else:
            raw = json.loads(text)
        return cls({k: v or {} for k, v in raw.items() if k != "shared"}, raw.get("shared") or {})

    def of(self, name: str) -> dict[str, Any]:
        return {**self.shared, **self.sections.get(name, {})}


def in_range(stage: str, start: str, stop: str) -> bool:
    """Whether a stage lies between two others, both included; 5.5 is between 5 and 6."""
    return Decimal(start) <= Decimal(stage) <= Decimal(stop)


def stages_between(df: DataFrame, stage: str, start: str, stop: str) -> DataFrame:
    """Rows whose stage lies between two others, both included, as exact decimals."""
    exact = "decimal(20,6)"
    return df.where(F.col(stage).cast(exact).between(F.lit(start).cast(exact), F.lit(stop).cast(exact)))


def run(stages: Sequence[Stage], settings: Settings, status_dir: str, start: str = DEFAULT_RANGE[0], stop: str = DEFAULT_RANGE[1], strict: bool = False) -> list[dict]:
    """Run the stages of a range in order and write each one's status, failures too; strict: stop at the first with errors."""
    out = []
    for stage in sorted(stages, key=lambda s: Decimal(s.id)):
        if not in_range(stage.id, start, stop):
            continue
        began = time.monotonic()
        try:
            total, errors = stage.run(settings.of(stage.name))
        except Exception as e:  # noqa: BLE001
            total, errors = 0, [{"stage": stage.name, "error": f"{type(e).__name__}: {e}"}]
        out.append(write_status(status_dir, stage.id, total, errors) | {"seconds": time.monotonic() - began})
        if strict and errors:
            raise RuntimeError(f"stage {stage.id} ({stage.name}) ended with {len(errors)} errors: {errors[0]}")
    return out


def real_time_factor(wall_s: float, audio_s: float) -> tuple[float | None, float | None]:
    """Wall time over audio time, and its inverse; null on zero."""
    return (wall_s / audio_s if audio_s else None), (audio_s / wall_s if wall_s else None)


def repeats(times: Sequence[float | None]) -> dict[str, float | None]:
    """avg, max and min of the successful repeats."""
    own = [t for t in times if t is not None]
    return {"avg": sum(own) / len(own), "max": max(own), "min": min(own)} if own else {"avg": None, "max": None, "min": None}
