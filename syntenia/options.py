"""Parameters of the operators. ``compat`` choices follow the established results; their opposites, the stated intent."""

from __future__ import annotations

from dataclasses import dataclass, field, fields


@dataclass(frozen=True)
class Clustering:
    """Islands of alignments: the default gap, and how much a long intron stretches it."""

    max_gap: int = 4000
    intron_factor: float = 1.1
    min_distance: int = 0
    use_quantile: bool = False
    quantile: float = 0.7


@dataclass(frozen=True)
class Scoring:
    min_similarity: float = 0.25
    min_score: float = 50.0
    length_factor: float = 0.1
    unknown_penalty: float = -0.1
    shrink: int = 60
    #: score * (1 - penalty) rewards overlong loci; intent: score * (1 + penalty)
    compat: bool = True


@dataclass(frozen=True)
class Expansion:
    default: int = 300
    incomplete: int = 3000
    missing_aa: int = 10
    use_template: bool = False
    margin_factor: float = 1.1
    template_margin: int = 6


@dataclass(frozen=True)
class LocusOptions:
    clustering: Clustering = field(default_factory=Clustering)
    scoring: Scoring = field(default_factory=Scoring)
    expansion: Expansion | None = None


@dataclass(frozen=True)
class Workflow:
    """Keys of a workflow configuration, with defaults."""

    target_genome: str = ""
    reference_genome: str = ""
    reference_gff: str = ""
    reference_locus_info: str = ""
    prefix: str = ""
    out_dir: str = "results"
    prebuilt: str = "NULL"
    ignore_errors: bool = False

    def __post_init__(self):
        if not self.prebuilt:
            object.__setattr__(self, "prebuilt", "NULL")


def run_log(options: Workflow, commit: str, when: str) -> list[str]:
    """Lines that tell when, by which version and with which options a workflow ran."""
    return [f"date\t{when}", f"version\t{commit}", *(f"{f.name}\t{getattr(options, f.name)}" for f in fields(options))]


def positive(value: int, name: str) -> int:
    """A whole number of at least 0."""
    if int(value) < 0:
        raise ValueError(f"{name} must not be negative: {value}")
    return int(value)
