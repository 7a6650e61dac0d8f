"""Business rules. Each rule is one Column, used by batch, streaming and tests alike."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, functions as F

# -- fixed values: thresholds, prefixes, labels --

COMMUTE_PREFIX = "Commute to work"
DISTANCE_LIMITS_BY_SPORT = {
    "Marche/running": 15_000,
    "Vélo/Trottinette/Autres": 25_000,
}
# Names of the two distance rules, as they stand in a rejection reason.
OUTLIER_LABELS = {
    "Marche/running": "distance_outlier_marche",
    "Vélo/Trottinette/Autres": "distance_outlier_vélo",
}
SPORT_TRANSPORT_MODES = ("Marche/running", "Vélo/Trottinette/Autres")
MIN_ACTIVITIES_WELLNESS = 15
ORPHAN_REASON = "employee_id_not_in_reference"
REASON_SEPARATOR = ", "

# -- end of fixed values --


# A limit without a label of its own is named by the words before the first slash of its sport.
_HEAD, _WORDS = re.compile(r"[^/]*"), re.compile(r"\w+")


@dataclass(frozen=True)
class Rule:
    """``broken`` is an SQL predicate that is true for a row that violates the rule.

    It must be false, not null, for every other row: then its plain negation is the filter
    for valid rows, and the parts of it that compare a column reach the file scan.
    """

    name: str
    broken: str


def sql_text(value: str) -> str:
    """A string as an SQL literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _too_far(sport: str, limit: int) -> Rule:
    return Rule(
        OUTLIER_LABELS.get(sport) or "_".join(["distance_outlier", *_WORDS.findall(_HEAD.match(sport)[0].casefold())]),
        f"distance IS NOT NULL AND distance > {limit} AND coalesce(contains(sport_type, {sql_text(sport)}), false)",
    )


def activity_rules(limits: dict[str, int] | None = None) -> list[Rule]:
    """The ordered rule list; the order is the order of names in a rejection reason."""
    limits = DISTANCE_LIMITS_BY_SPORT if limits is None else limits
    return [
        Rule("id_null", "id IS NULL"),
        Rule("employee_id_null", "employee_id IS NULL"),
        Rule("sport_type_null", "sport_type IS NULL OR sport_type = ''"),
        Rule("elapsed_time_invalid", "elapsed_time IS NULL OR elapsed_time <= 0"),
        Rule("start_datetime_null", "start_datetime IS NULL"),
        Rule("distance_negative", "distance IS NOT NULL AND distance < 0"),
        *(_too_far(sport, limit) for sport, limit in limits.items()),
    ]


def delete_rules() -> list[Rule]:
    """What a delete event must satisfy when it may carry nothing but its key."""
    return [rule for rule in activity_rules() if rule.name == "id_null"]


def is_commute(sport: str = "sport_type") -> Column:
    return F.expr(f"coalesce(startswith({sport}, {sql_text(COMMUTE_PREFIX)}), false)")


def is_deleted(flag: str = "__deleted") -> Column:
    """The delete flag is text; only the exact text ``true`` deletes."""
    return F.expr(f"{flag} <=> 'true'")


def is_active(flag: str = "__deleted") -> Column:
    return F.expr(f"NOT ({flag} <=> 'true')")


def uses_sport_transport(mode: str = "transport_mode") -> Column:
    modes = ", ".join(sql_text(m) for m in SPORT_TRANSPORT_MODES)
    return F.expr(f"coalesce({mode} IN ({modes}), false)")


def earns_prime(mode: str = "transport_mode", commutes: str = "total_commute_activities") -> Column:
    return uses_sport_transport(mode) & F.expr(f"coalesce({commutes} > 0, false)")


def earns_wellness(externals: str = "total_external_activities") -> Column:
    return F.expr(f"coalesce({externals} >= {MIN_ACTIVITIES_WELLNESS}, false)")
