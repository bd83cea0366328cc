"""The record of job runs: one run at a time, and where a failed one stopped.

A run notes itself before it begins and after each stage. Two that begin at
once write the same version of the record, and one fails. A run that failed
can be resumed after its last finished stage; so can one that was killed, and
should it still be alive, its next note fails and it stops.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import SparkSession

from basketflow.sources import versions
from basketflow.sources.zones import Zones

RUNNING, FAILED, DONE = "running", "failed", "done"
Stage = tuple[str, Callable[[], object]]


def run(spark: SparkSession, zones: Zones, stages: list[Stage], resume: bool = False) -> dict[str, object]:
    """Run the stages in order; returns what each returned, which should be
    plain data, as noted. An error ends the run and is raised. `resume` skips
    the stages that the last run finished, unless that ended well."""
    folder = f"{zones.clean}/_runs"
    number, last = versions.newest(spark, folder)
    if last and last["state"] == RUNNING and not resume:
        raise RuntimeError(f"a run has not ended: {folder}; resume it if it is no longer there")
    results = last["results"] if last and resume and last["state"] != DONE else {}

    def note(state: str) -> None:
        nonlocal number
        number += 1
        versions.commit(spark, folder, number, {"state": state, "results": results})

    note(RUNNING)
    for name, stage in stages:
        if name in results:
            continue
        try:
            results[name] = stage()
        except Exception:
            note(FAILED)
            raise
        note(RUNNING)
    note(DONE)
    return results
