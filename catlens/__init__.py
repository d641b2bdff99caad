"""catlens: categorical classification on Spark (cleaning, labels, splits, MLlib models, reports)."""

from catlens.config import FIXTURE_CONFIG, JobConfig

__all__ = ["FIXTURE_CONFIG", "JobConfig"]
__version__ = "0.1.0"
