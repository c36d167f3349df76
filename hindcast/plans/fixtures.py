"""Logical tables derived from the given ones, as SQL text that Spark and DuckDB both run.

They are analogues to exercise the operators on, not facts of any game: a half
inning is a day of one user's events, and outs are not capped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BASE = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

VIEWS = {
    "game": """SELECT o_orderkey AS game_id, CAST(o_orderdate AS DATE) AS game_date, CAST(year(o_orderdate) AS INT) AS season,
      CAST(o_orderkey % 10 AS INT) AS home_team, CAST((o_orderkey % 10 + 1 + o_custkey % 9) % 10 AS INT) AS away_team,
      CAST(CAST(floor(o_totalprice) AS BIGINT) % 7 AS INT) AS home_runs, CAST(CAST(floor(o_totalprice / 7) AS BIGINT) % 7 AS INT) AS away_runs,
      o_orderstatus AS status, CASE WHEN o_orderkey % 13 = 0 THEN 'postseason' ELSE 'regular' END AS stage FROM {orders}""",
    "pitch": """SELECT event_id, user_id AS game_id, CAST(ts AS DATE) AS half_id, ts, event_type AS pitch_result,
      CAST(CAST(floor(value) AS BIGINT) % 3 AS INT) AS pitch_type, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS outs,
      CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS runs, CASE WHEN event_type IN ('purchase', 'signup', 'error') THEN 1 ELSE 0 END AS ends_pa,
      CASE WHEN event_id % 10 = 0 THEN NULL ELSE value END AS plate_x, CASE WHEN event_id % 15 = 0 THEN NULL ELSE value / 2 END AS plate_z,
      CAST(event_id % 4 AS INT) AS batter, CAST(event_id % 3 AS INT) AS runner FROM {events}""",
    "log": """SELECT user_id AS player_id, ts, CAST(ts AS DATE) AS day, CAST(user_id % 2 AS INT) AS role_id, 1 AS exposure,
      CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS hits, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS outs, event_id FROM {events}""",
    "final": """SELECT *, CASE WHEN home_runs > away_runs THEN 'H' WHEN home_runs = away_runs THEN 'D' ELSE 'A' END AS truth FROM {game} WHERE status = 'F'""",
    "team_game": """SELECT game_id, game_date, season, status, stage, 'home' AS side, home_team AS team, away_team AS opponent, home_runs AS runs, away_runs AS allowed FROM {game}
      UNION ALL SELECT game_id, game_date, season, status, stage, 'away', away_team, home_team, away_runs, home_runs FROM {game}""",
    "cls": "SELECT 'H' AS cls, 3 AS w UNION ALL SELECT 'D', 1 UNION ALL SELECT 'A', 2",
    "preds": """SELECT f.game_id, c.cls, CAST(c.w + (f.game_id + c.w) % 4 AS DOUBLE) / CAST(sum(c.w + (f.game_id + c.w) % 4) OVER (PARTITION BY f.game_id) AS DOUBLE) AS p FROM {final} f CROSS JOIN {cls} c""",
    "ks": "SELECT 0 AS k UNION ALL SELECT 1 UNION ALL SELECT 2 UNION ALL SELECT 3 UNION ALL SELECT 4 UNION ALL SELECT 5 UNION ALL SELECT 6",
    "pmf": """SELECT f.game_id, ks.k, CAST(1 + (f.game_id + ks.k) % 4 AS DOUBLE) / CAST(sum(1 + (f.game_id + ks.k) % 4) OVER (PARTITION BY f.game_id) AS DOUBLE) AS p FROM {final} f CROSS JOIN {ks} ks""",
    "pmf2": """SELECT f.game_id, ks.k, CAST(1 + (f.game_id + 2 * ks.k) % 5 AS DOUBLE) / CAST(sum(1 + (f.game_id + 2 * ks.k) % 5) OVER (PARTITION BY f.game_id) AS DOUBLE) AS p FROM {final} f CROSS JOIN {ks} ks""",
    "mondays": """SELECT DATE '2024-01-01' AS anchor UNION ALL SELECT DATE '2024-01-08' UNION ALL SELECT DATE '2024-01-15' UNION ALL SELECT DATE '2024-01-22' UNION ALL SELECT DATE '2024-01-29'""",
    "state": """SELECT event_id, game_id, half_id, ts, pitch_type AS state, runs, outs, runner,
      CAST(sum(runs) OVER (PARTITION BY game_id, half_id ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS rem FROM {pitch}""",
    "table": """SELECT season, team, CAST(sum(CASE WHEN runs > allowed THEN 1 ELSE 0 END) AS BIGINT) AS wins, CAST(sum(CASE WHEN runs < allowed THEN 1 ELSE 0 END) AS BIGINT) AS losses,
      CAST(sum(CASE WHEN runs = allowed THEN 1 ELSE 0 END) AS BIGINT) AS draws, CAST(sum(runs - allowed) AS BIGINT) AS run_diff FROM {team_game} WHERE status = 'F' GROUP BY season, team""",
    "ranked": "SELECT *, CAST(rank() OVER (PARTITION BY season ORDER BY wins DESC, run_diff DESC, team) AS INT) AS rank FROM {table}",
    "draws": """SELECT game_id % 40 AS draw_id, game_id % 4 AS repeat, team, CAST(sum(CASE WHEN runs > allowed THEN 1 ELSE 0 END) AS BIGINT) AS wins
      FROM {team_game} WHERE status = 'P' GROUP BY game_id % 40, game_id % 4, team""",
}


def needed(text: str) -> list[str]:
    """Views that a text names in braces, with what they need, in order."""
    out: list[str] = []
    for name in VIEWS:
        if f"{{{name}}}" in text:
            out += [x for x in [*needed(VIEWS[name]), name] if x not in out]
    return out


def duckdb_sql(body: str) -> str:
    """One statement: the views it needs as common table expressions before it."""
    names = {x: f'v_{x}' for x in VIEWS} | {x: x for x in BASE}
    ctes = ", ".join(f"v_{v} AS ({VIEWS[v].format(**names)})" for v in needed(body))
    body = body.strip().format(**names)
    if body.upper().startswith("WITH "):
        # A statement that recurs says so before its first view.
        word, body = ("WITH RECURSIVE", body[15:]) if body.upper().startswith("WITH RECURSIVE ") else ("WITH", body[5:])
        return f"{word} {ctes}, {body}" if ctes else f"{word} {body}"
    return f"WITH {ctes} {body}" if ctes else body


class Tables:
    """The given tables and the derived views of one directory, as attributes."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir, self._made = spark, sf_dir, {}

    def __getattr__(self, name: str) -> DataFrame:
        if name in BASE:
            return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        if name not in VIEWS:
            raise AttributeError(name)
        if name not in self._made:
            text = VIEWS[name]
            parts = {x: getattr(self, x) for x in (*BASE, *VIEWS) if f"{{{x}}}" in text}
            self._made[name] = self.spark.sql(text, **parts)
        return self._made[name]

    def sql(self, text: str) -> DataFrame:
        return self.spark.sql(text, **{x: getattr(self, x) for x in (*BASE, *VIEWS) if f"{{{x}}}" in text})
