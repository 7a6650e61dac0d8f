"""Text of a notification, as SQL expressions."""

from __future__ import annotations

# -- fixed values: wording, colours, date format --

TITLE_DELETED = "Activité supprimée — Employé "
TITLE_LATEST = "Dernière activité sportive — Employé "
COLOR_DELETED = 15158332
COLOR_LATEST = 3066993
DATE_FORMAT = "dd/MM/yyyy 'à' HH:mm"
DATE_UNKNOWN = "date inconnue"
BATCH_NOTE = "*(%d activité(s) dans ce lot)*"
NO_VALUE = "None"

# -- end of fixed values --

_SPLIT = 134217729.0  # 2^27 + 1


def shown(column: str) -> str:
    return f"coalesce(CAST({column} AS STRING), '{NO_VALUE}')"


def minutes_text(seconds: str) -> str:
    """Seconds as minutes with one decimal, rounded from the exact binary value of the quotient.

    ``format_string`` rounds the shortest decimal form half up. That differs from exact
    rounding only where the true quotient is a tie, which needs ``seconds % 6 == 3``. There
    the sign of the quotient's rounding error decides, taken from a product that is split
    into two exact halves; an exact tie goes to the even digit.
    """
    total = f"CAST(coalesce({seconds}, 0) AS BIGINT)"
    size = f"abs({total})"
    quotient = f"({size} / 60.0D)"
    odd = f"({size} div 3)"  # the tie is odd / 20
    high = f"({quotient} * {_SPLIT}D - ({quotient} * {_SPLIT}D - {quotient}))"
    error = f"(({high} * 20.0D - CAST({odd} AS DOUBLE)) + ({quotient} - {high}) * 20.0D)"
    below = f"({odd} div 2)"  # tenths under the tie
    up = f"({error} > 0 OR ({error} = 0 AND {below} % 2 = 1))"
    tenths = f"({below} + IF({up}, 1L, 0L))"
    tie = f"concat({tenths} div 10, '.', {tenths} % 10)"
    text = f"IF({size} % 6 = 3, {tie}, format_string('%.1f', {quotient}))"
    return f"concat(IF({total} < 0, '-', ''), {text})"


def date_text(timestamp: str) -> str:
    return f'coalesce(date_format({timestamp}, "{DATE_FORMAT}"), \'{DATE_UNKNOWN}\')'
