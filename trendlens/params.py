"""Job parameters. Defaults are the values the original batch job uses."""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class Params:
    min_year: int = 2012            # first publication year kept, also the start of every forecast series
    top_words: int = 12             # words kept per (discipline, year)
    trend_min_len: int = 4          # a trend word needs more than 3 letters
    basket_min_len: int = 5         # a basket word needs more than 4 letters
    target_year: int = 2026         # forecasts run up to and including this year
    floor: int = 3                  # smallest forecast count
    damp: float = 0.85              # a forecast never drops below this share of the last value
    min_support: float = 0.0008     # association rules: minimum pair support (share of baskets)
    min_confidence: float = 0.20    # association rules: minimum confidence
    rules_per_source: int = 8       # rules kept per antecedent
    include_forecast_baskets: bool = True

    def with_(self, **kw) -> "Params":
        return replace(self, **kw)


# The thresholds used on the documents fixture (see FIXTURES.md): the job defaults would give
# a minimum pair count of 1 on a thousand titles, i.e. every co-occurring pair is "frequent".
FIXTURE_PARAMS = Params(min_support=0.01, min_confidence=0.10)
