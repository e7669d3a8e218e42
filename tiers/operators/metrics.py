"""Row-count metrics taken inside the job that already runs (no extra actions)."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


@dataclass
class Counter:
    """A named row counter attached to a frame with ``observe``.

    The count is collected by the next action over a plan that contains the
    observed frame (typically the table write) and read afterwards with ``value``.
    """

    name: str
    observation: Observation

    @property
    def value(self) -> int:
        return int(self.observation.get["rows"])


def count_rows(df: DataFrame, name: str) -> tuple[DataFrame, Counter]:
    obs = Observation(f"{name}_{uuid.uuid4().hex[:8]}")
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), Counter(name, obs)
