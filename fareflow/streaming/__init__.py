from . import seen, upsert
from .exact import silver_stage
from .progress import StageStopped, follow
from .stages import append_stage, bronze_stage, error_stage, finish, gold_stage, gold_totals, rescued_stage, run_layers
from .upsert import keyed_stage, read_keyed
from .windows import late_trips, window_stage, zone_windows

__all__ = [
    "StageStopped",
    "append_stage",
    "bronze_stage",
    "error_stage",
    "finish",
    "follow",
    "gold_stage",
    "gold_totals",
    "keyed_stage",
    "late_trips",
    "read_keyed",
    "rescued_stage",
    "run_layers",
    "silver_stage",
    "window_stage",
    "zone_windows",
]
