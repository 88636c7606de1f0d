from touchline.functions.dates import (
    age_at,
    age_in_season,
    calendar_features,
    exact_age,
    parse_date,
)
from touchline.functions.formation import (
    formation_digits,
    formation_lenient,
    formation_strict,
    rule_strategy,
)
from touchline.functions.text import contains_flag, contains_ignoring_case, fold_accents
from touchline.functions.values import (
    clip_upper,
    is_missing,
    lookup,
    money,
    ratio,
    replace_value,
    to_number,
)

__all__ = [
    "age_at", "age_in_season", "calendar_features", "clip_upper", "contains_flag",
    "contains_ignoring_case", "exact_age", "fold_accents", "formation_digits",
    "formation_lenient", "formation_strict", "is_missing", "lookup", "money", "parse_date",
    "ratio", "replace_value", "rule_strategy", "to_number",
]
