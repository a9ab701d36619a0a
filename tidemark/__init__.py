"""Keyed, resumable table migration on Spark DataFrames."""

from tidemark.plans.jobs import JobStateError, Migration
from tidemark.plans.spec import Copy, Merge, TransformSpec, lookup, register

__all__ = ["Copy", "JobStateError", "Merge", "Migration", "TransformSpec", "lookup", "register"]
