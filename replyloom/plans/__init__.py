from .judging import PreferenceResult, run_judge, run_preference
from .recorded import RunLedger, record_judge, record_stage1, record_stage2
from .rewriting import run_stage1, run_stage2

__all__ = [
    "PreferenceResult",
    "RunLedger",
    "record_judge",
    "record_stage1",
    "record_stage2",
    "run_judge",
    "run_preference",
    "run_stage1",
    "run_stage2",
]
