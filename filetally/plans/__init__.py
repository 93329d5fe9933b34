"""Migration planning: snapshot and delta plans, state folding, applying controls."""

from filetally.plans.apply import apply_operations, target_after
from filetally.plans.delta import deduplicate_changes, plan_delta, split_delta
from filetally.plans.migration import Plan, migration_inventory, plan_migration
from filetally.plans.snapshot import plan_snapshot
from filetally.plans.state import next_state, state_changes
from filetally.plans.transfers import transfer_records

__all__ = [
    "Plan",
    "apply_operations",
    "deduplicate_changes",
    "migration_inventory",
    "next_state",
    "plan_delta",
    "plan_migration",
    "plan_snapshot",
    "split_delta",
    "state_changes",
    "target_after",
    "transfer_records",
]
