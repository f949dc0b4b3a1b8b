from recsift.functions.metrics import harmonic_mean, r6, safe_ratio
from recsift.functions.text import (
    concat_blank,
    contains_ci,
    english_stop_words,
    join_words,
    split_genres,
    tokens,
    year_from_title,
)

__all__ = [
    "concat_blank", "contains_ci", "english_stop_words", "harmonic_mean", "join_words",
    "r6", "safe_ratio", "split_genres", "tokens", "year_from_title",
]
