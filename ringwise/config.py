"""Run parameters shared by every query (one object instead of scattered literals)."""

from __future__ import annotations

from dataclasses import dataclass

# Thresholds and round counts used by the analyses.
DEFAULT_AS_OF = "2001-09-01"
HIGH_FRAUD_THRESHOLD = 0.7
MIN_RING_CLAIMS = 3
RING_AVG_SCORE = 0.6
RING_CONCENTRATION = 40.0
PAGERANK_RESET = 0.15
PAGERANK_ROUNDS = 10
LABEL_ROUNDS = 5
LANDMARK_COUNT = 5

# Relationship names of the claims graph.
FILED_BY = "filed_by"
PROCESSED_BY = "processed_by"
SERVICED_BY = "serviced_by"
SHARED_CONTACT = "shared_contact"
REPEAT_ADJUSTER = "repeat_adjuster"
REPEAT_PROVIDER = "repeat_provider"
FREQUENT_COLLABORATION = "frequent_collaboration"

ALL_RELATIONSHIPS = (
    FILED_BY,
    PROCESSED_BY,
    SERVICED_BY,
    SHARED_CONTACT,
    REPEAT_ADJUSTER,
    REPEAT_PROVIDER,
    FREQUENT_COLLABORATION,
)

NOT_CONTACT = tuple(r for r in ALL_RELATIONSHIPS if r != SHARED_CONTACT)

# Named relationship views (edge subsets) of the claims graph.
VIEWS = {
    "full": ALL_RELATIONSHIPS,
    "ring": (FILED_BY, SHARED_CONTACT),
    "entity": (SHARED_CONTACT, REPEAT_ADJUSTER, REPEAT_PROVIDER, FREQUENT_COLLABORATION),
    "contact": (SHARED_CONTACT,),
}


@dataclass(frozen=True)
class RiskConfig:
    """Parameters of a fraud-ring run.

    ``threshold`` is stored as an integer number of thousandths so that score
    comparisons stay exact (scores are carried as ``score_milli``).
    """

    threshold_milli: int = int(round(HIGH_FRAUD_THRESHOLD * 1000))
    min_ring_claims: int = MIN_RING_CLAIMS
    ring_avg_milli: int = int(round(RING_AVG_SCORE * 1000))
    ring_concentration: float = RING_CONCENTRATION
    as_of: str = DEFAULT_AS_OF
    pagerank_reset: float = PAGERANK_RESET
    pagerank_rounds: int = PAGERANK_ROUNDS
    label_rounds: int = LABEL_ROUNDS
    landmarks: int = LANDMARK_COUNT
    max_path_length: int = 10

    @property
    def threshold(self) -> float:
        return self.threshold_milli / 1000.0
