"""What the lake needs once a day: fewer and better files."""

from __future__ import annotations

from datetime import date

from .lake import Lake


def upkeep(lake: Lake, before: date | None = None) -> dict[str, int]:
    """Rewrite closed days of Bronze, merge finished batch folders. Returns how many, by table.

    Bronze counts days, the others batches. ``before``: see ``CompactedDays.compact``. Each step
    counts once it is complete, so a lost run is made up for by the next. Run it beside the
    landing if you like, but not beside the job that writes the batch folders.
    """
    done = {"bronze": len(lake.landed.compact(before))}
    return done | {name: log.compact() for name, log in lake.logs.items()}
