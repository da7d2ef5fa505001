from almanac.functions.columns import (
    cast_columns,
    normalise_key,
    season_of,
    trend_sentence,
    with_season,
)

__all__ = ["cast_columns", "normalise_key", "season_of", "trend_sentence", "with_season"]
