"""Consolidate overlapping relational snapshots on Spark, and migrate the legacy schema."""

from sediment.plans.convert import convert_archive
from sediment.plans.merge import MergeResult, merge_archives
from sediment.specs import FkRule, TableSpec, default_specs

__all__ = ["FkRule", "MergeResult", "TableSpec", "convert_archive", "default_specs", "merge_archives"]
