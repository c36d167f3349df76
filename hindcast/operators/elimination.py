"""Who can still be in or out: games to come as flows of wins to teams.

Each game gives one point to one of its two teams.  Whether all points can go to
teams without any getting more than it may is a flow from games to teams; a
point moves on from a team that has too many along a game that it won.  If none
can, the teams reached are a minimum cut: they must share more points among
themselves than they may have.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.cloudpickle import register_pickle_by_value

# These functions travel to the executors with their code: nothing has to be installed there.
register_pickle_by_value(sys.modules[__name__])

#: Teams may be numbers or names; a pair stands in their order.
Games = Mapping[tuple, int]


def can_hold(games: Games, most: Mapping[int, int]) -> bool:
    """Whether every game between two teams can be given to one of them with no team above its most; teams not named have no bound."""
    if any(m < 0 for m in most.values()):
        return False
    points, won = dict.fromkeys(most, 0), {}
    for (a, b), n in games.items():
        # What one may have without bound goes there; else to the team with more room.
        to = a if a not in most else b if b not in most else max(a, b, key=lambda t: most[t] - points[t])
        if to in most:
            points[to] += n
        other = b if to == a else a
        won[to, other] = won.get((to, other), 0) + n
    for team in most:
        while points[team] > most[team]:
            before, queue, end = {team: team}, [team], None
            while queue and end is None:
                u = queue.pop(0)
                for (x, v), n in won.items():
                    if x == u and n and v not in before:
                        before[v] = u
                        queue.append(v)
                        if v not in most or points[v] < most[v]:
                            end = v
                            break
            if end is None:
                return False
            path = [end]
            while path[-1] != team:
                path.append(before[path[-1]])
            steps = list(zip(path[:0:-1], path[-2::-1]))
            move = min([points[team] - most[team], *(won[s] for s in steps), *([most[end] - points[end]] if end in most else [])])
            for u, v in steps:
                won[u, v] -= move
                won[v, u] = won.get((v, u), 0) + move
            points[team] -= move
            if end in most:
                points[end] += move
    return True


def can_choose(candidates: Sequence[int], need: int, holds: Callable[[list[int]], bool]) -> bool:
    """Whether some `need` of the candidates hold together; what doesn't hold, holds with no more added."""

    def grow(chosen: list[int], at: int) -> bool:
        if len(chosen) >= need:
            return True
        for k in range(at, len(candidates) - (need - len(chosen)) + 1):
            if holds([*chosen, candidates[k]]) and grow([*chosen, candidates[k]], k + 1):
                return True
        return False

    return need <= 0 or grow([], 0)


def status_of(team: int, wins: Mapping[int, int], games: Games, slots: int, draws: bool) -> str:
    """clinched, eliminated or open for a team of a season, over all outcomes of the games to come.

    Teams equal in wins stand against one that wants to have clinched, and with one that isn't eliminated yet.  The
    team loses, or wins, all its games: nothing is worse, or better, for it.
    """
    others = [t for t in wins if t != team]
    own = {t: games.get((min(t, team), max(t, team)), 0) for t in others}
    rest = {k: n for k, n in games.items() if team not in k}
    left = {t: sum(n for k, n in rest.items() if t in k) for t in others}
    inside = lambda chosen: {k: n for k, n in rest.items() if k[0] in chosen and k[1] in chosen}
    # In: can as many others as there are slots win what the team has? Points are losses here, and each may have so many.
    spare = {t: left[t] - max(0, wins[team] - wins[t] - own[t]) for t in others}
    reach = sorted((t for t in others if spare[t] >= 0), key=lambda t: -spare[t])
    if not can_choose(reach, slots, lambda some: can_hold(inside(some), {t: spare[t] for t in some})):
        return "clinched"
    # Out: can all others but the slots before the team's be kept from passing it?
    best = wins[team] + sum(own.values())
    room = {t: best - wins[t] for t in others}
    behind = sorted((t for t in others if room[t] >= 0), key=lambda t: -room[t] + left[t])
    fewest = len(others) - (slots - 1)
    if not can_choose(behind, fewest, lambda some: draws or can_hold(inside(some), {t: room[t] for t in some})):
        return "eliminated"
    return "open"


def statuses(slots: int, draws: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For mapInArrow: the status of each row's team, by its bound, or if it has none from its season's table and games, arrays of teams and pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = b.column("bound").to_pylist()
            for r, status in enumerate(out):
                if status is None:
                    wins = {t["team"]: t["wins"] for t in b.column("table")[r].as_py()}
                    games = {(g["a"], g["b"]): g["n"] for g in b.column("games")[r].as_py() or []}
                    out[r] = status_of(b.column("team")[r].as_py(), wins, games, slots, draws)
            kept = ["season", "team", "can_reach", "beyond"]
            yield pa.RecordBatch.from_arrays([*map(b.column, kept), pa.array(out, pa.string())], names=[*kept, "status"])

    return run
