"""Whole jobs: read, transform, overwrite."""

from clientele.plans.pipeline import Outcome, Pipeline
from clientele.plans.presets import PRESETS, preset

__all__ = ["PRESETS", "Outcome", "Pipeline", "preset"]
