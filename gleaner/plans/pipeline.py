"""A linear pipeline of DataFrame stages with a record of each stage."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

Stage = Callable[[DataFrame], DataFrame | None]


@dataclass
class StageResult:
    name: str
    ok: bool = True
    rows: int | None = None
    elapsed_ms: int = 0
    error: str | None = None


@dataclass
class PipelineResult:
    data: DataFrame | None
    stages: list[StageResult] = field(default_factory=list)

    @property
    def ok(self) -> bool:
        return all(s.ok for s in self.stages)


class Pipeline:
    """Stages in order; a stage that returns None passes its input on, one that fails ends the run and is recorded.

    Plans are lazy: by default a stage only builds its plan. With `materialise` each stage's result is
    written to the session's checkpoint folder and counted, so that times and failures belong to stages.
    """

    def __init__(self) -> None:
        self.stages: list[tuple[str, Stage]] = []

    def add(self, name: str, stage: Stage) -> Pipeline:
        self.stages.append((name, stage))
        return self

    def run(self, df: DataFrame, materialise: bool = False) -> PipelineResult:
        from gleaner.session import ensure_checkpoint_dir

        result = PipelineResult(df)
        for name, stage in self.stages:
            began, r = time.monotonic(), StageResult(name)
            try:
                out = stage(result.data)
                out = result.data if out is None else out
                if materialise:
                    ensure_checkpoint_dir(out.sparkSession)
                    out = out.checkpoint()
                    r.rows = out.count()
                result.data = out
            except Exception as e:
                r.ok, r.error = False, f"{type(e).__name__}: {e}"
            r.elapsed_ms = int((time.monotonic() - began) * 1000)
            result.stages.append(r)
            if not r.ok:
                break
        return result
