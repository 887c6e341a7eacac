"""gamecast: box-score analytics and forecasting on Spark DataFrames.

Games are nested documents (two teams, two box scores, each with a list of
player lines). The library unnests them, builds per-player and per-team
histories for whole tables of requests, fits one linear trend per series
with built-in aggregates, and forecasts the next game.
"""

__version__ = "0.1.0"
