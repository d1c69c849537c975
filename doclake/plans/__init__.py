"""The whole run: sync, ingest, parse in batches, flatten."""

from doclake.plans.pipeline import PipelineParams, RunSummary, run_batches, run_pipeline

__all__ = ["PipelineParams", "RunSummary", "run_batches", "run_pipeline"]
