"""Column-level helpers (all built-in Spark expressions, no Python UDF)."""

from touchline.functions.clock import now, today  # noqa: F401
from touchline.functions.codes import (  # noqa: F401
    CARD_KINDS, EVENT_TYPES, GOAL_KINDS, event_type, is_state, match_result, scorer_type,
)
from touchline.functions.dates import safe_date, safe_hour, safe_timestamp, with_date_parts  # noqa: F401
