from __future__ import annotations

import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from gamecast.schema import GAME_SCHEMA, LINE_FIELDS  # noqa: E402
from gamecast.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session("*", shuffle_partitions=8, app="gamecast-tests", driver_memory="4g")
    yield s


def line(player, pts):
    d = {f.name: None for f in LINE_FIELDS}
    d.update(player=player, pts=pts)
    return d


def game(game_id, date, home, away, home_players, away_players, home_first=True, home_missing=False):
    """A game document; players are (name, pts) pairs; home_players=None gives an empty box."""
    hp = [line(n, p) for n, p in (home_players or [])]
    ap = [line(n, p) for n, p in (away_players or [])]
    hs, as_ = sum(p for _, p in home_players or []), sum(p for _, p in away_players or [])
    ht = dict(name=home, abbreviation=home, score=hs, home=True, won=int(hs > as_))
    at = dict(name=away, abbreviation=away, score=as_, home=False, won=int(as_ > hs))
    team_line = lambda s: {**{f.name: None for f in LINE_FIELDS}, "pts": s}
    hb = dict(players=None if home_missing else hp, team=team_line(hs), won=int(hs > as_))
    ab = dict(players=ap, team=team_line(as_), won=int(as_ > hs))
    teams, box = ([ht, at], [hb, ab]) if home_first else ([at, ht], [ab, hb])
    if isinstance(date, str):
        date = dt.datetime.fromisoformat(date)
    return dict(game_id=game_id, date=date, teams=teams, box=box)


@pytest.fixture(scope="session")
def make_games(spark):
    def make(games):
        return spark.createDataFrame(games, GAME_SCHEMA)
    return make


@pytest.fixture(scope="session")
def small_games(make_games):
    """Hand-made edge cases (see FIXTURES.md section 7)."""
    gs = [
        game(1, "2012-01-03", "BOS", "NYK", [("Ann", 10), ("Bo O'Neil", 4)], [("Cy", 7)]),
        game(2, "2012-01-05", "NYK", "BOS", [("Cy", 9)], [("Ann", 12), ("Bo O'Neil", 6)], home_first=False),
        game(3, "2012-01-20", "BOS", "MIA", [("Ann", 14)], None),
        game(4, "2012-04-30", "MIA", "BOS", [("Dee", 5)], [("Ann", 16)]),
        game(5, "2012-10-01", "BOS", "NYK", [("Ann", 18), ("Solo", 3)], [("Cy", 11)], home_first=False),
        game(6, "2013-01-03", "BOS", "NYK", [("Ann", 20)], [("Cy", 13)]),
        game(7, "2013-01-07", "NYK", "BOS", None, [("Ann", 22)], home_missing=True),
        game(8, "2013-01-24", "BOS", "NYK", [("Ann", 24), ("Flat", 5)], [("Cy", 15), ("Flat2", 8)]),
        game(9, "2013-02-10", "BOS", "BOS", [("Ann", 26), ("Flat", 5)], [("Eve", 1)]),
    ]
    return make_games(gs)
