"""Study configuration: plain frozen values that become operator arguments."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Treatment:
    treatment_id: str
    label: str
    start: str  # ISO date
    end: str  # ISO date


@dataclass(frozen=True)
class StudyConfig:
    project: str
    kpis: dict[str, str]  # KPI column -> aggregate used on daily data
    treatments: tuple[Treatment, ...]
    covariates: tuple[str, ...]  # further numeric model inputs of the population table
    segments: tuple[str, ...]
    pre_days: tuple[int, ...] = (90,)
    post_days: tuple[int, ...] = (30,)
    treatment_columns: dict[str, str] = field(default_factory=dict)  # raw name -> name
    population_columns: dict[str, str] = field(default_factory=dict)
    segment_columns: dict[str, str] = field(default_factory=dict)
    tune: bool = False

    @property
    def kpi_names(self) -> list[str]:
        return list(self.kpis)

    @property
    def treatment_ids(self) -> list[str]:
        return [t.treatment_id for t in self.treatments]

    @property
    def horizon(self) -> int:
        """Effects are measured at the longest post period."""
        return max(self.post_days)
