"""Job configuration: column names, class count, model and split parameters.

Every constant of the ticket job is an argument here, so the same code
serves any messy categorical table. Defaults are the ticket job's values.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

# Fixed values of the ticket job (must equal the original job's choices).
TICKET_CATEGORICAL_COLUMNS = (
    "Registration State",
    "Plate Type",
    "Vehicle Body Type",
    "Vehicle Make",
    "Issuing Agency",
    "Violation County",
    "Vehicle Color",
    "Unregistered Vehicle?",
    "Violation Precinct",
)
TICKET_SAMPLE_COLUMNS = (
    "Vehicle Body Type",
    "Vehicle Make",
    "Plate Type",
    "Violation County",
    "Violation Precinct",
)
TOP_N_CLASSES = 8
CURRENT_YEAR = 2026
NUM_TREES = 20
MAX_DEPTH = 8
SEED = 42
TEST_FRACTION = 0.2
OTHER_LABEL = "OTHER"
UNKNOWN = "UNKNOWN"


@dataclass(frozen=True)
class JobConfig:
    """Names and parameters of one classification job."""

    code_col: str = "Violation Code"
    time_col: str = "Violation Time"
    year_col: str = "Vehicle Year"
    categorical_cols: tuple[str, ...] = TICKET_CATEGORICAL_COLUMNS
    # Row key used by the hash split and for ordered output (NULL keys are
    # hashed by the row's content). None: a hash of the selected raw columns,
    # and copies of a row are shared out between the sides.
    key_col: str | None = None

    # derived column names
    code_out: str = "violation_code"
    hour_bucket_out: str = "violation_hour_bucket"
    year_bucket_out: str = "vehicle_year_bucket"
    label_col: str = "target_label"

    # Model features; None means every categorical column plus both buckets.
    features: tuple[str, ...] | None = None
    sample_cols: tuple[str, ...] = TICKET_SAMPLE_COLUMNS

    top_n_classes: int = TOP_N_CLASSES
    current_year: int = CURRENT_YEAR

    # split
    split: str = "hash"  # "hash" | "stratified" | "random"
    test_fraction: float = TEST_FRACTION
    split_salt: str = ""
    # hash buckets for the stratified split (power of two); None: about the
    # square root of the largest label, which bounds the boundary-bucket task
    stratify_buckets: int | None = None

    # models
    # Fit the indexer (and NB) from one aggregation of (label, feature,
    # category) counts instead of MLlib's per-stage passes.
    fit_from_counts: bool = True
    smoothing: float = 1.0
    num_trees: int = NUM_TREES
    max_depth: int = MAX_DEPTH
    seed: int = SEED
    # From this depth on a forest caches each row's node and checkpoints it every so many levels.
    deep_depth: int = 12
    deep_checkpoint: int = 10
    # A deep forest's nodes of at most so many distinct rows are split to the end by one task each.
    deep_node_rows: int = 1 << 18
    # Canonical layout before a forest fit: one hash shuffle of the training
    # rows so the forest does not depend on the input's file layout. Off: no
    # shuffle; the forest is then reproducible only for the same input layout.
    canonical_layout: bool = True
    # Fixed partition count of that layout, whatever the session's settings
    # (raise it with the data: a partition should fit an executor's memory).
    layout_partitions: int = 32
    # At most this many copies of one row are placed together.
    layout_chunk_rows: int = 10_000

    # "cache" (MEMORY_AND_DISK, recomputed from lineage after executor loss)
    # or "checkpoint" (reliable copy in spark.checkpoint.dir).
    materialize: str = "cache"

    @property
    def feature_cols(self) -> tuple[str, ...]:
        if self.features is not None:
            return tuple(self.features)
        return tuple(self.categorical_cols) + (self.hour_bucket_out, self.year_bucket_out)

    @property
    def needed_cols(self) -> tuple[str, ...]:
        cols = [self.code_col, self.time_col, self.year_col, *self.categorical_cols]
        if self.key_col is not None and self.key_col not in cols:
            cols.insert(0, self.key_col)
        return tuple(cols)

    def with_(self, **kw) -> "JobConfig":
        return replace(self, **kw)


# Column mapping of the ``tickets_raw`` fixture view (see sources.tickets).
FIXTURE_CONFIG = JobConfig(
    code_col="code_raw",
    time_col="time_raw",
    year_col="year_raw",
    categorical_cols=("segment", "zone", "color", "status", "priority", "nation"),
    key_col="row_id",
    sample_cols=("segment", "zone", "color", "status", "nation"),
)
