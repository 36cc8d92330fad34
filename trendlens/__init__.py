"""trendlens: research-hotspot analytics on Spark DataFrames.

Batch job:  raw papers -> cleaned papers -> keyword trends (+ forecast) -> association rules.
Reports:    theme river, leaderboard, rising words, bridge words, keyword network, search, topic evidence.
Streaming:  continuous landing of JSON paper batches and a windowed search-log rollup.

Every operator takes DataFrames and returns a DataFrame; none does I/O or collects rows.
"""

from trendlens.params import Params

__all__ = ["Params"]
