"""replyloom: preparing, asking for, scoring and analysing model replies on Spark."""

from .plans import run_judge, run_preference, run_stage1, run_stage2
from .session import configure, materialize

__all__ = [
    "configure",
    "materialize",
    "run_judge",
    "run_preference",
    "run_stage1",
    "run_stage2",
]
