"""syncflow: data synchronisation, changelog and reconciliation operators on Spark DataFrames."""

from syncflow.plans.spec import SyncSpec, build, run

__all__ = ["SyncSpec", "build", "run"]
