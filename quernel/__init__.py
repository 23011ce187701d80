"""quernel: reconciliation, comparison and clean-up of entity data on Spark."""

from quernel.session import configure, shared_dir, table

__all__ = ["configure", "shared_dir", "table"]
