"""Every tunable of the matching run in one place."""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class MatchConfig:
    run_id: str = "run_001"

    # Scoring and banding.
    lei_score: float = 0.99
    score_cap: float = 0.98
    country_bonus: float = 0.03
    auto_threshold: float = 0.90
    review_threshold: float = 0.75
    review_depth: int = 5
    #: "sequence" is the matching-blocks ratio, "levenshtein" the edit-distance form of it.
    similarity: str = "sequence"
    #: From 200 characters of the register name on, leave out characters that make up more than a hundredth
    #: of it, as difflib does by default.
    popularity_heuristic: bool = False
    #: "half_up" rounds the decimal form of a score, "half_even" its exact binary value, as Python's round does.
    rounding: str = "half_up"

    # Blocking.
    prefix_length: int = 4
    #: Pair clients and register rows whose cleaned names are both empty.
    include_empty_block: bool = False
    #: Rows per side of one join cell; a block beyond it is spread over several cells.
    cell_rows: int = 2_000

    # Matching to the internal list.
    submitted_fuzzy_threshold: float = 0.78
    register_fuzzy_threshold: float = 0.82
    #: Drop legal words from the names compared with the internal list.
    strip_legal_words: bool = True
    #: One gold row for a client without an internal match, however many parents it has.
    one_row_without_match: bool = True

    #: Carry clients without any candidate through to the internal mapping.
    keep_unmatched: bool = False
    #: Only ACTIVE edges, one parent per child and role (the latest period start).
    active_edges_only: bool = False

    #: Rows per exported table, the first by its keys; all rows by default.
    export_rows: int | None = None

    def __post_init__(self) -> None:
        if self.similarity not in ("sequence", "levenshtein"):
            raise ValueError(f"unknown similarity: {self.similarity!r}")
        if self.rounding not in ("half_up", "half_even"):
            raise ValueError(f"unknown rounding: {self.rounding!r}")
        if self.prefix_length < 1 or self.cell_rows < 1 or self.review_depth < 1:
            raise ValueError("prefix_length, cell_rows and review_depth must be positive")

    def with_(self, **changes) -> MatchConfig:
        return replace(self, **changes)
