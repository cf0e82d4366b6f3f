"""Fixed values of the survey study and the default parameters of the steps.

Fixed values: these must agree with the published questionnaire scoring and
with the analysis being matched, so they are stated here plainly.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# Severity bands of the nine-item depression score, right-closed.
SEVERITY_EDGES = [-1, 4, 9, 14, 19, 27]
SEVERITY_LABELS = ["Minimal", "Mild", "Moderate", "Moderately_Severe", "Severe"]

PSS_ITEMS = [f"pss_{i}" for i in range(1, 11)]
GAD_ITEMS = [f"gad_{i}" for i in range(1, 8)]
PHQ_ITEMS = [f"phq_{i}" for i in range(1, 10)]

POSITIVE_AFFECT_ITEMS = [
    "happy_yesterday", "laughed_yesterday", "learned_yesterday", "enjoyment_yesterday",
]
NEGATIVE_AFFECT_ITEMS = [
    "worried_yesterday", "felt_depressed_yesterday", "angry_yesterday",
    "stress_yesterday", "lonely_yesterday",
]

REFERENCE_YEAR = 2022
AGE_RANGE = (14, 80)
IMPUTED_COLUMNS = ["education_years_father", "education_years_mother"]
SHARE_COLUMNS = ["gender", "socioeconomic_status", "ethnicity", "phq9_category"]

MODEL_METRICS = ["Kernel_Alignment", "Kernel_Polarization", "FSM", "Complex_Ratio"]


@dataclass(frozen=True)
class SurveyConfig:
    """Parameters of the four-step study; defaults are the published ones."""

    key: str = "resp_id"
    target: str = "phq9_total"
    category: str = "phq9_category"
    label: str = "cluster_label"
    seed: int = 42
    k_min: int = 2
    k_max: int = 10
    kmeans_restarts: int = 10
    silhouette_rows: int = 2_000
    eps_rows: int = 20_000
    subtractive_rows: int = 2_000
    min_points: int = 5
    min_eps: float = 0.5
    micro_clusters: int = 500
    n_trees: int = 100
    whole_rows: int = 20_000  # nodes of so many rows are finished in one task
    boosting_rounds: int = 100
    rbf_features: int = 256
    num_kernels: int = 3
    max_features: int = 5
    kernel_power: int = 2
    ordered_labels: list[str] = field(default_factory=lambda: list(SEVERITY_LABELS))
