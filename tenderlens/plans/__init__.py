"""The three stages as a user calls them."""

from tenderlens.plans.stage1 import Stage1Result, run_stage1
from tenderlens.plans.stage2 import run_stage2
from tenderlens.plans.stage3 import Stage3Result, run_stage3

__all__ = ["Stage1Result", "run_stage1", "run_stage2", "Stage3Result", "run_stage3"]
