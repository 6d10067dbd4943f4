"""Code tables and the derived labels built from them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Event type code -> event name. Codes not listed map to OTHER.
EVENT_TYPES = {
    1: "GOAL",
    2: "OWN_GOAL",
    3: "PENALTY",
    4: "RED_CARD",
    5: "YELLOW_CARD",
    6: "SUBSTITUTION",
}
OTHER = "OTHER"

# Event names that count as goals and as cards.
GOAL_KINDS = ("GOAL", "OWN_GOAL", "PENALTY")
CARD_KINDS = ("YELLOW_CARD", "RED_CARD")

# Match result labels.
HOME_WIN, AWAY_WIN, DRAW = "HOME_WIN", "AWAY_WIN", "DRAW"


def event_type(type_id: str | Column) -> Column:
    """Map an event code to its name with one map lookup (a literal map, codegen'd)."""
    c = F.col(type_id) if isinstance(type_id, str) else type_id
    lookup = F.create_map(*[x for k, v in EVENT_TYPES.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.try_element_at(lookup, c), F.lit(OTHER))


def is_state(state_id: str | Column, code: int) -> Column:
    """True when the state equals ``code``; False (never NULL) otherwise."""
    c = F.col(state_id) if isinstance(state_id, str) else state_id
    return F.coalesce(c == code, F.lit(False))


def match_result(home: str | Column, away: str | Column) -> Column:
    """HOME_WIN / AWAY_WIN / DRAW. A missing score compares as NULL and falls to DRAW."""
    h = F.col(home) if isinstance(home, str) else home
    a = F.col(away) if isinstance(away, str) else away
    return F.when(h > a, HOME_WIN).when(h < a, AWAY_WIN).otherwise(DRAW)


def scorer_type(kind: str | Column) -> Column:
    c = F.col(kind) if isinstance(kind, str) else kind
    return (F.when(c == "OWN_GOAL", "OWN_GOAL")
            .when(c == "PENALTY", "PENALTY")
            .otherwise("REGULAR"))
