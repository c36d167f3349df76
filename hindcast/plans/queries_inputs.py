"""Queries of sources, gates, quality checks and joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from hindcast.functions import scalars
from hindcast.operators import gates, joins, quality, sets
from hindcast.plans.registry import query
from hindcast.sources import lineage

CUT = "DATE '1998-01-01'"

def cut():
    return F.lit("1998-01-01").cast("date")

LINE = ["l_orderkey", "l_linenumber"]

# Sources and lineage ---------------------------------------------------------------------------------------------


@query("read_raw", "SELECT o_orderkey, o_orderstatus, round(o_totalprice, 6) AS o_totalprice FROM {orders}")
def _(t):
    return lineage.read_raw(t.spark, f"{t.sf_dir}/orders.parquet", "o_orderkey long, o_orderstatus string, o_totalprice double")


@query("with_context", "SELECT game_id, 'wdl' AS target, '1998-01-01' AS ref_time, 'v1' AS version FROM {game}")
def _(t):
    df = lineage.with_context(t.game.select("game_id"), target="wdl", ref_time="1998-01-01", version="v1")
    return df.select("game_id", "context.*")


_VERSIONS = "l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey, l_suppkey"


@query("version_as_of", f"SELECT {_VERSIONS} FROM {{lineitem}} WHERE l_shipdate <= TIMESTAMP '1998-01-01' QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC) = 1")
def _(t):
    return lineage.version_as_of(t.lineitem, LINE, "l_shipdate", cut(), ["l_partkey", "l_suppkey"]).select(*LINE, "l_partkey", "l_suppkey")


@query("version_latest", f"SELECT {_VERSIONS} FROM {{lineitem}} QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC) = 1")
def _(t):
    return lineage.version_latest(t.lineitem, LINE, "l_shipdate", ["l_partkey", "l_suppkey"]).select(*LINE, "l_partkey", "l_suppkey")


def _versions(t):
    a = lineage.version_as_of(t.lineitem, LINE, "l_shipdate", cut(), ["l_partkey", "l_suppkey"])
    return a, lineage.version_latest(t.lineitem, LINE, "l_shipdate", ["l_partkey", "l_suppkey"])


_TWO = """WITH b AS (SELECT * FROM {lineitem} QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC) = 1),
 a AS (SELECT * FROM {lineitem} WHERE l_shipdate <= TIMESTAMP '1998-01-01' QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC) = 1) """


@query("version_diff", _TWO + """SELECT coalesce(a.l_orderkey, b.l_orderkey) AS l_orderkey, coalesce(a.l_linenumber, b.l_linenumber)::BIGINT AS l_linenumber,
 CASE WHEN a.l_orderkey IS NULL THEN 'added' WHEN b.l_orderkey IS NULL THEN 'removed' ELSE 'changed' END AS change,
 CASE WHEN a.l_orderkey IS NULL OR b.l_orderkey IS NULL THEN '' ELSE concat_ws(',', CASE WHEN a.l_partkey <> b.l_partkey THEN 'l_partkey' END, CASE WHEN a.l_suppkey <> b.l_suppkey THEN 'l_suppkey' END) END AS changed_columns
 FROM a FULL JOIN b ON a.l_orderkey = b.l_orderkey AND a.l_linenumber = b.l_linenumber
 WHERE a.l_orderkey IS NULL OR b.l_orderkey IS NULL OR a.l_partkey <> b.l_partkey OR a.l_suppkey <> b.l_suppkey""")
def _(t):
    return lineage.version_diff(*_versions(t), LINE, ["l_partkey", "l_suppkey"])


@query("impact_trace", """WITH c AS (SELECT DISTINCT p_partkey AS id FROM {part} WHERE p_partkey % 50 = 0),
 o AS (SELECT DISTINCT l_orderkey AS id FROM {lineitem} JOIN c ON l_partkey = c.id), k AS (SELECT DISTINCT o_custkey AS id FROM {orders} JOIN o ON o_orderkey = o.id)
 SELECT 1::BIGINT AS layer, id FROM o UNION ALL SELECT 2::BIGINT, id FROM k""")
def _(t):
    edges = [t.lineitem.select(F.col("l_partkey").alias("parent_id"), F.col("l_orderkey").alias("child_id")), t.orders.select(F.col("o_orderkey").alias("parent_id"), F.col("o_custkey").alias("child_id"))]
    return lineage.impact_trace(t.part.where("p_partkey % 50 = 0").select(F.col("p_partkey").alias("id")), edges)


# Lineage of any depth: parts that others are made of, with chains, diamonds, cycles and dead ends.
_LINKS = "(SELECT p_partkey AS parent_id, CASE WHEN s = 0 THEN (p_partkey * 3 + 1) % m ELSE (p_partkey * 5 + 2) % m END AS child_id FROM {part}, (SELECT max(p_partkey) + 1 AS m FROM {part}) n, (VALUES (0), (1)) v(s) WHERE p_partkey % 7 <> 0 AND (s = 0 OR p_partkey % 3 = 1))"


@query("impact_trace_any_depth", f"""WITH RECURSIVE l AS MATERIALIZED {_LINKS}, r(id, depth) AS (SELECT child_id, 1 FROM l WHERE parent_id % 400 = 3 UNION SELECT child_id, depth + 1 FROM r JOIN l ON parent_id = id WHERE depth < 60)
 SELECT id, min(depth)::BIGINT AS depth FROM r GROUP BY 1""")
def _(t):
    """The fewest steps to everything downstream; the SQL walks all ways of up to 60 steps."""
    p, m = F.col("p_partkey"), t.part.agg((F.max("p_partkey") + 1).alias("m"))
    rows = t.part.where("p_partkey % 7 <> 0").crossJoin(F.broadcast(m))  # one row
    edges = rows.select(p.alias("parent_id"), ((p * 3 + 1) % F.col("m")).alias("child_id")).union(rows.where("p_partkey % 3 = 1").select(p, (p * 5 + 2) % F.col("m")))
    return lineage.impact_trace(t.part.where("p_partkey % 400 = 3").select(p.alias("id")), edges)


def _manifest(t):
    targets = t.orders.select(F.col("o_orderkey").alias("game_id"), F.col("o_orderdate").cast("date").alias("day"), (F.col("o_orderstatus") != "O").alias("finished")).where("game_id % 97 <> 0")
    captures = t.lineitem.groupBy(F.col("l_orderkey").alias("game_id")).agg(F.count_if(F.expr("l_returnflag = 'N'")).alias("n_rows"), F.bool_or(F.expr("l_quantity > 49.5 and l_tax > 0.07")).alias("failed"))
    return targets, lineage.manifest_compare(targets, captures, "game_id")


_STATES = """WITH t AS (SELECT o_orderkey AS game_id, CAST(o_orderdate AS DATE) AS day, o_orderstatus <> 'O' AS finished FROM {orders} WHERE o_orderkey % 97 <> 0),
 c AS (SELECT l_orderkey AS game_id, count(*) FILTER (l_returnflag = 'N') AS n_rows, bool_or(l_quantity > 49.5 AND l_tax > 0.07) AS failed FROM {lineitem} GROUP BY 1),
 m AS (SELECT coalesce(t.game_id, c.game_id) AS game_id, CASE WHEN t.game_id IS NULL THEN 'unscheduled' WHEN NOT finished THEN 'unfinished' WHEN c.game_id IS NULL THEN 'missing' WHEN failed THEN 'access failed' WHEN n_rows = 0 THEN 'empty' ELSE 'captured' END AS state
  FROM t FULL JOIN c ON t.game_id = c.game_id) """


@query("manifest_compare", _STATES + "SELECT * FROM m")
def _(t):
    return _manifest(t)[1]


@query("completeness_by_period", _STATES + """SELECT year(day)::BIGINT AS season, month(day)::BIGINT AS period, count(*) FILTER (state = 'captured') AS included, count(*) FILTER (state = 'missing') AS missing, count(*) FILTER (state = 'access failed') AS failed, count(*) AS n
 FROM m JOIN t USING (game_id) GROUP BY ROLLUP (1, 2)""")
def _(t):
    targets, m = _manifest(t)
    return lineage.completeness_by_period(m.join(targets, "game_id").select("state", F.year("day").alias("season"), F.month("day").alias("period")), ["season", "period"])


@query("scrub_request", "SELECT event_id, CASE WHEN event_id % 2 = 0 THEN '{{\"k\":' || to_json(json_extract_string(props, '$.k')) || '}}' ELSE '{{}}' END AS request FROM {events}")
def _(t):
    request = F.when(F.col("event_id") % 2 == 0, F.to_json(F.struct(F.get_json_object("props", "$.k").alias("k"), F.lit("s").alias("Token")))).otherwise('{"password": "x", "API_KEY": "y"}')
    return lineage.scrub_request(t.events.select("event_id", request.alias("request")), "request", ["token", "password", "api_key"])


@query("parse_payload", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM {events}")
def _(t):
    return lineage.parse_payload(t.events.select("event_id", "props"), "props", "k long")


@query("reconstruct_sample", """SELECT o_orderkey AS sample_id, o_custkey AS label, l_partkey AS parent_id, l_linenumber::BIGINT AS part_no, CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN 'train' ELSE 'test' END AS split
 FROM {orders} JOIN {lineitem} ON o_orderkey = l_orderkey""")
def _(t):
    ids = t.orders.select(F.col("o_orderkey").alias("sample_id"))
    samples = t.orders.select(F.col("o_orderkey").alias("sample_id"), F.col("o_custkey").alias("label"))
    parents = t.lineitem.select(F.col("l_orderkey").alias("sample_id"), F.col("l_partkey").alias("parent_id"), F.col("l_linenumber").alias("part_no"))
    splits = t.orders.select(F.col("o_orderkey").alias("sample_id"), F.when(F.col("o_orderdate") < cut(), "train").otherwise("test").alias("split"))
    return lineage.reconstruct_sample(ids, samples, parents, splits)


# Gates -----------------------------------------------------------------------------------------------------------


@query("gate_event_time", "SELECT game_id, game_date FROM {game} WHERE game_date < " + CUT)
def _(t):
    return gates.gate_event_time(t.game.select("game_id", "game_date"), "game_date", cut())


_AVAIL = "SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey, l_suppkey FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey "


@query("gate_available", _AVAIL + "WHERE l_quantity <> 13 AND l_shipdate <= o_orderdate")
def _(t):
    rows = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).withColumn("available_at", F.when(F.col("l_quantity") != 13, F.col("l_shipdate")))
    return gates.gate_available(rows, "available_at", F.col("o_orderdate")).select(*LINE, "l_partkey", "l_suppkey")


@query("gate_sequence", "SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber FROM {lineitem} WHERE l_shipdate < TIMESTAMP '1998-01-01' OR (l_shipdate = TIMESTAMP '1998-01-01' AND l_linenumber < 4)")
def _(t):
    return gates.gate_sequence(t.lineitem, ["l_shipdate", "l_linenumber"], [F.lit("1998-01-01").cast("timestamp_ntz"), F.lit(4)]).select(*LINE)


@query("gate_provenance", "SELECT event_id FROM {events} WHERE event_id % 7 <> 0 AND event_id % 11 <> 0")
def _(t):
    df = t.events.select("event_id", F.when(F.col("event_id") % 7 != 0, "s1").alias("source"), F.when(F.col("event_id") % 11 != 0, "v1").alias("version"))
    return gates.gate_provenance(df, ["source", "version"]).select("event_id")


@query("gate_stacked", "SELECT game_id FROM {game} WHERE game_date < DATE '1998-01-01' AND game_date + CAST(game_id % 30 AS INT) < DATE '1998-01-01'")
def _(t):
    preds = t.game.select("game_id", F.col("game_date").alias("train_end"), F.date_add("game_date", (F.col("game_id") % 30).cast("int")).alias("generated_at"))
    return gates.gate_stacked(preds, cut()).select("game_id")


def _rules():
    return [("not final", F.col("status") == "F"), ("too late", F.col("game_date") < cut()), ("same score", F.col("home_runs") != F.col("away_runs"))]


@query("split_reasons", """SELECT coalesce(reason, 'admitted') AS outcome, count(*) AS n FROM (SELECT CASE WHEN status <> 'F' THEN 'not final' WHEN game_date >= DATE '1998-01-01' THEN 'too late' WHEN home_runs = away_runs THEN 'same score' END AS reason FROM {game}) GROUP BY 1""")
def _(t):
    ok, bad = gates.split_reasons(t.game, _rules())
    return ok.select(F.lit("admitted").alias("outcome")).union(bad.select("reason")).groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


@query("strip_current_event", "SELECT event_id, game_id FROM {pitch}")
def _(t):
    return gates.strip_current_event(t.pitch.select("event_id", "game_id", "plate_x", "pitch_type", "pitch_result"), ["plate_x", "pitch_type", "pitch_result"])


@query("stage_filter", "SELECT game_id FROM {game} WHERE stage = 'postseason'")
def _(t):
    return gates.stage_filter(t.game, "postseason").select("game_id")


@query("finals_only", "SELECT game_id FROM {game} WHERE status = 'F'")
def _(t):
    return gates.finals_only(t.game).select("game_id")


@query("actual_pitch_filter", "SELECT event_id FROM {pitch} WHERE pitch_result NOT IN ('signup', 'error')")
def _(t):
    return gates.actual_pitch_filter(t.pitch, ~F.col("pitch_result").isin("signup", "error")).select("event_id")


@query("valid_location", "SELECT event_id, plate_x IS NOT NULL AND plate_z IS NOT NULL AS valid, CASE WHEN plate_x IS NULL AND plate_z IS NULL THEN 'no location' WHEN plate_x IS NULL THEN 'no plate_x' WHEN plate_z IS NULL THEN 'no plate_z' END AS why_invalid FROM {pitch}")
def _(t):
    return gates.valid_location(t.pitch, "plate_x", "plate_z").select("event_id", "valid", "why_invalid")


@query("map_outcome", "SELECT event_id, CASE pitch_result WHEN 'purchase' THEN 'hit' WHEN 'error' THEN 'out' WHEN 'view' THEN 'ball' ELSE 'unmapped' END AS cls FROM {pitch}")
def _(t):
    mapping = t.spark.sql("SELECT * FROM VALUES ('purchase', 'hit'), ('error', 'out'), ('view', 'ball') AS m(pitch_result, cls)")
    return gates.map_outcome(t.pitch.select("event_id", "pitch_result"), mapping, "pitch_result").select("event_id", "cls")


@query("team_perspective", "SELECT game_id, side, team::BIGINT AS team, opponent::BIGINT AS opponent, runs::BIGINT AS runs, allowed::BIGINT AS allowed FROM {team_game}")
def _(t):
    return gates.team_perspective(t.game).select("game_id", "side", "team", "opponent", "runs", "allowed")


# Quality ---------------------------------------------------------------------------------------------------------


@query("qc_types", "SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'price' ELSE '' END || CASE WHEN o_orderkey % 10 = 0 THEN ',day' WHEN o_orderkey % 2 = 0 THEN 'day' ELSE '' END AS bad_columns FROM {orders} WHERE o_orderkey % 5 = 0 OR o_orderkey % 2 = 0")
def _(t):
    df = t.orders.select("o_orderkey", F.when(F.col("o_orderkey") % 5 == 0, "n/a").otherwise("1.5").alias("price"), F.when(F.col("o_orderkey") % 2 == 0, "soon").otherwise("1998-01-01").alias("day"))
    return quality.qc_types(df, {"price": "double", "day": "date"}).select("o_orderkey", "bad_columns")


@query("qc_nulls", "SELECT 'plate_x' AS column_name, count(*) FILTER (plate_x IS NULL) AS nulls, count(*) AS n FROM {pitch} UNION ALL SELECT 'plate_z', count(*) FILTER (plate_z IS NULL), count(*) FROM {pitch} UNION ALL SELECT 'game_id', 0, count(*) FROM {pitch}")
def _(t):
    return quality.qc_nulls(t.pitch.select("plate_x", "plate_z", "game_id"))


@query("qc_duplicates", "SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, count(*) AS n FROM {lineitem} GROUP BY ALL HAVING count(*) > 1")
def _(t):
    return quality.qc_duplicates(t.lineitem, LINE)


@query("dedupe", f"SELECT {_VERSIONS} FROM {{lineitem}} QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey, l_suppkey) = 1")
def _(t):
    return quality.dedupe(t.lineitem, LINE, [F.col("l_shipdate"), F.col("l_partkey"), F.col("l_suppkey")]).select(*LINE, "l_partkey", "l_suppkey")


@query("qc_range", "SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey, l_suppkey, concat_ws(',', CASE WHEN l_quantity NOT BETWEEN 2 AND 45 THEN 'l_quantity' END, CASE WHEN l_discount NOT BETWEEN 0.0 AND 0.08 THEN 'l_discount' END) AS bad_columns FROM {lineitem} WHERE l_quantity NOT BETWEEN 2 AND 45 OR l_discount NOT BETWEEN 0.0 AND 0.08")
def _(t):
    return quality.qc_range(t.lineitem, {"l_quantity": (2, 45), "l_discount": (0.0, 0.08)}).select(*LINE, "l_partkey", "l_suppkey", "bad_columns")


@query("qc_reference", "SELECT o_orderkey FROM {orders} WHERE o_custkey NOT IN (SELECT c_custkey FROM {customer} WHERE c_acctbal > 0)")
def _(t):
    return quality.qc_reference(t.orders.select("o_orderkey", F.col("o_custkey").alias("c_custkey")), t.customer.where("c_acctbal > 0"), "c_custkey").select("o_orderkey")


@query("qc_order", "SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, gap, backwards FROM (SELECT *, l_linenumber - lag(l_linenumber) OVER w > 1 AS gap, l_shipdate < lag(l_shipdate) OVER w AS backwards FROM (SELECT l_orderkey, l_linenumber, min(l_shipdate) AS l_shipdate FROM {lineitem} GROUP BY ALL) WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber)) WHERE coalesce(gap, false) OR coalesce(backwards, false)")
def _(t):
    lines = t.lineitem.groupBy(*LINE).agg(F.min("l_shipdate").alias("l_shipdate"))
    return quality.qc_order(lines, ["l_orderkey"], "l_linenumber", "l_shipdate").select(*LINE, "gap", "backwards")


@query("qc_repeat_outcome", "SELECT l_orderkey, count(*) AS n_rows, count(DISTINCT l_linenumber) AS n_pa FROM {lineitem} GROUP BY 1")
def _(t):
    return quality.qc_repeat_outcome(t.lineitem, LINE, ["l_orderkey"])


@query("qc_reconcile", "WITH s AS (SELECT l_orderkey AS k, sum(l_linenumber)::BIGINT AS v FROM {lineitem} GROUP BY 1), o AS (SELECT o_orderkey AS k, (o_orderkey % 9)::BIGINT AS v FROM {orders}) SELECT coalesce(s.k, o.k) AS k, s.v AS from_events, o.v AS official FROM s FULL JOIN o ON s.k = o.k WHERE s.v IS DISTINCT FROM o.v")
def _(t):
    return quality.qc_reconcile(t.lineitem.select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("v")), t.orders.select(F.col("o_orderkey").alias("k"), (F.col("o_orderkey") % 9).alias("v")), ["k"], "v")


@query("quarantine", "SELECT game_id, CASE WHEN status <> 'F' THEN 'not final' WHEN game_date >= DATE '1998-01-01' THEN 'too late' ELSE 'same score' END AS reason FROM {game} WHERE status <> 'F' OR game_date >= DATE '1998-01-01' OR home_runs = away_runs")
def _(t):
    return quality.quarantine(t.game, _rules())[1].select("game_id", "reason")


@query("quality_report", "SELECT 'range' AS check_name, (SELECT count(*) FROM {lineitem} WHERE l_quantity NOT BETWEEN 2 AND 45) AS failures, (SELECT count(*) FROM {lineitem}) AS checked UNION ALL SELECT 'duplicates', (SELECT count(*) FROM (SELECT 1 FROM {lineitem} GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)), (SELECT count(*) FROM {lineitem})")
def _(t):
    return quality.quality_report({"range": (quality.qc_range(t.lineitem, {"l_quantity": (2, 45)}), t.lineitem), "duplicates": (quality.qc_duplicates(t.lineitem, LINE), t.lineitem)})


@query("conditional_verdict", "WITH b AS (SELECT pitch_result AS item, CASE WHEN event_id % 9 = 0 THEN NULL WHEN event_id % 8 = 0 THEN 'view' ELSE pitch_result END AS f FROM {pitch}) SELECT item, n, missing, wrong, CASE WHEN (missing + wrong) / n <= 0.15 THEN 'include' WHEN (missing + wrong) / n <= 0.22 THEN 'limit' ELSE 'exclude' END AS verdict FROM (SELECT item, count(*) AS n, count(*) FILTER (f IS NULL) AS missing, count(*) FILTER (f <> item) AS wrong FROM b GROUP BY 1)")
def _(t):
    truth = t.pitch.select("event_id", F.col("pitch_result").alias("item"))
    found = truth.where("event_id % 9 <> 0").withColumn("item", F.when(F.col("event_id") % 8 == 0, "view").otherwise(F.col("item")))
    return quality.conditional_verdict(truth, found, "event_id", "item", (0.15, 0.22))


@query("qc_counts", "SELECT event_id FROM {log} WHERE (event_id % 3)::INT > exposure OR hits > event_id % 3")
def _(t):
    df = t.log.withColumn("abs", (F.col("event_id") % 3).cast("int"))
    return quality.qc_counts(df, [("abs", "exposure"), ("hits", "abs")]).select("event_id")


@query("qc_no_overlap", "WITH p AS (SELECT player_id, max(day) AS last FROM {log} WHERE day < DATE '2024-01-15' GROUP BY 1), r AS (SELECT player_id, min(day) AS first FROM {log} WHERE day >= DATE '2024-01-15' GROUP BY 1) SELECT player_id, CASE WHEN last + 1 > first THEN 'overlap' ELSE 'gap' END AS problem FROM p FULL JOIN r USING (player_id) WHERE last + 1 IS DISTINCT FROM first")
def _(t):
    a = t.log.where("day < '2024-01-15'").groupBy("player_id").agg(F.date_add(F.max("day"), 1).alias("ends"))
    r = t.log.where("day >= '2024-01-15'").groupBy("player_id").agg(F.min("day").alias("begins"))
    return quality.qc_no_overlap(a, r, "player_id", "ends", "begins").select("player_id", "problem")


@query("qc_probability", "SELECT game_id FROM (SELECT game_id, sum(CASE WHEN game_id % 10 = 3 THEN p * 1.01 ELSE p END) AS s FROM {preds} GROUP BY 1) WHERE abs(s - 1) > 1e-9 OR game_id % 15 = 4")
def _(t):
    """Some forecasts don't add up, and some games' probabilities are all unknown."""
    p = F.when(F.col("game_id") % 15 != 4, F.when(F.col("game_id") % 10 == 3, F.col("p") * 1.01).otherwise(F.col("p")))
    return quality.qc_probability(t.preds.withColumn("p", p), ["game_id"]).select("game_id")


@query("qc_joint_marginal", "SELECT game_id, k::BIGINT AS k FROM {pmf} WHERE game_id % 20 = 7")
def _(t):
    from hindcast.operators.value import joint_score

    joint = joint_score(t.pmf, t.pmf2).withColumnRenamed("h", "k")
    reported = t.pmf.withColumn("p", F.when(F.col("game_id") % 20 == 7, F.col("p") + 0.01).otherwise(F.col("p")))
    return quality.qc_joint_marginal(joint, reported, ["game_id", "k"]).select("game_id", "k")


@query("qc_score_wdl", "SELECT DISTINCT game_id FROM {pmf} WHERE game_id % 20 = 7")
def _(t):
    from hindcast.operators.value import joint_score, wdl_from_scores

    joint = joint_score(t.pmf, t.pmf2)
    wdl = wdl_from_scores(joint).withColumn("p_home", F.when(F.col("game_id") % 20 == 7, F.col("p_home") + 0.01).otherwise(F.col("p_home")))
    return quality.qc_score_wdl(joint, wdl).select("game_id")


@query("qc_final_state", "SELECT event_id FROM {state} WHERE ts = (SELECT max(ts) FROM {events}) OR (event_id % 50 = 0 AND rem <> 0)")
def _(t):
    last = t.events.agg(F.max("ts").alias("m"))
    s = t.state.crossJoin(last).select("event_id", F.when(F.col("ts") == F.col("m"), True).otherwise(F.col("event_id") % 50 == 0).alias("is_final"), F.when(F.col("ts") == F.col("m"), F.lit(None)).otherwise(F.col("rem")).alias("runs_remaining"), F.lit(0.5).alias("win_value"))
    return quality.qc_final_state(s).select("event_id")


# Joins -----------------------------------------------------------------------------------------------------------


@query("join_ids", "SELECT event_id, player_id, hits::BIGINT AS hits FROM {pitch} JOIN {log} USING (event_id)")
def _(t):
    return joins.join_ids(t.pitch.select("event_id"), t.log.select("event_id", "player_id", "hits"), ["event_id"])


@query("join_population", "SELECT c_custkey, o_orderkey FROM {customer} LEFT JOIN {orders} ON c_custkey = o_custkey")
def _(t):
    return joins.join_population(t.customer.select("c_custkey"), t.orders.select(F.col("o_custkey").alias("c_custkey"), "o_orderkey"), ["c_custkey"])


@query("join_missing", "SELECT o_orderkey FROM {orders} WHERE o_orderkey NOT IN (SELECT l_orderkey FROM {lineitem})")
def _(t):
    return joins.join_missing(t.orders.select("o_orderkey"), t.lineitem.select(F.col("l_orderkey").alias("o_orderkey")), ["o_orderkey"])


@query("join_common_sample", "SELECT game_id FROM {game} WHERE game_id IN (SELECT game_id FROM {final})")
def _(t):
    return joins.join_common_sample(t.game.select("game_id"), t.final, ["game_id"])


@query("join_asof_snapshot", "SELECT r.event_id, s.event_id AS snapshot_id FROM (SELECT * FROM {events} WHERE event_type = 'purchase') r ASOF LEFT JOIN (SELECT * FROM {events} WHERE event_type = 'view') s ON r.user_id = s.user_id AND r.ts > s.ts")
def _(t):
    req, snap = t.events.where("event_type = 'purchase'").select("event_id", "user_id", "ts"), t.events.where("event_type = 'view'").select("user_id", "ts", F.col("event_id").alias("snapshot_id"))
    return joins.join_asof_snapshot(req, snap, ["user_id"], "ts", "ts", ["snapshot_id"]).select("event_id", "snapshot_id")


@query("join_asof_hot", "SELECT r.event_id, s.event_id AS snapshot_id FROM (SELECT * FROM {events} WHERE event_type = 'purchase') r ASOF LEFT JOIN (SELECT * FROM {events} WHERE event_type = 'view') s ON r.user_id % 2 = s.user_id % 2 AND r.ts > s.ts")
def _(t):
    """Two keys hold all rows: each is cut into slices of time, and the last snapshot is carried across them."""
    rows = t.events.withColumn("half", F.col("user_id") % 2)
    req, snap = rows.where("event_type = 'purchase'").select("event_id", "half", "ts"), rows.where("event_type = 'view'").select("half", "ts", F.col("event_id").alias("snapshot_id"))
    return joins.join_asof_snapshot(req, snap, ["half"], "ts", "ts", ["snapshot_id"], hot=100).select("event_id", "snapshot_id")


@query("join_horizon", "SELECT event_id, anchor FROM {log} JOIN {mondays} ON day >= anchor AND day < anchor + 28")
def _(t):
    return joins.join_horizon(t.log, t.mondays, "ts", 28).select("event_id", "anchor")


@query("join_rest_of_season", "SELECT event_id, anchor FROM {log} JOIN {mondays} ON day >= anchor AND day < DATE '2024-01-28'")
def _(t):
    anchors = t.mondays.withColumns({"season": F.lit(2024), "end": F.lit("2024-01-28").cast("date")})
    return joins.join_rest_of_season(t.log.withColumn("season", F.lit(2024)), anchors, "day", "season", "end").select("event_id", "anchor")


@query("join_boundary_pair", "SELECT event_id, state::BIGINT AS pre, lead(state) OVER (PARTITION BY game_id ORDER BY ts)::BIGINT AS post FROM {state}")
def _(t):
    return joins.join_boundary_pair(t.state, "game_id", ["ts"], ["state"]).select("event_id", F.col("pre.state").alias("pre"), F.col("post.state").alias("post"))


@query("join_panel", "SELECT player_id, anchor FROM (SELECT DISTINCT player_id FROM {log}) CROSS JOIN {mondays}")
def _(t):
    return joins.join_panel(t.log.select("player_id").distinct(), t.mondays)


@query("join_season_rules", "SELECT game_id, CASE WHEN season < 1998 THEN 4 WHEN season < 2001 THEN 5 END::BIGINT AS slots FROM {game}")
def _(t):
    rules = t.spark.sql("SELECT id AS season, IF(id < 1998, 4, 5) AS slots FROM range(1995, 2001)").select(F.col("season").cast("int"), "slots")
    return joins.join_season_rules(t.game, rules, ["season"]).select("game_id", "slots")


@query("join_participants", "SELECT game_id, half_id, min_by(batter, ts)::BIGINT AS started, max_by(batter, ts)::BIGINT AS credited FROM {pitch} GROUP BY 1, 2")
def _(t):
    return joins.join_participants(t.pitch, ["game_id", "half_id"], F.col("ts"), "batter")


# Sets ------------------------------------------------------------------------------------------------------------


@query("union_captures", "SELECT game_id, status, NULL::BIGINT AS season FROM {game} WHERE game_id % 2 = 0 UNION ALL SELECT game_id, NULL, season FROM {game} WHERE game_id % 2 = 1")
def _(t):
    return sets.union_captures([t.game.where("game_id % 2 = 0").select("game_id", "status"), t.game.where("game_id % 2 = 1").select("season", "game_id")])


@query("target_minus_captured", "SELECT o_orderkey AS k FROM {orders} EXCEPT SELECT l_orderkey FROM {lineitem}")
def _(t):
    return sets.target_minus_captured(t.orders.select(F.col("o_orderkey").alias("k")), t.lineitem.select(F.col("l_orderkey").alias("k")))


@query("common_keys", "SELECT game_id FROM {game} WHERE status = 'F' INTERSECT SELECT game_id FROM {game} WHERE stage = 'regular' INTERSECT SELECT game_id FROM {game} WHERE home_runs > 2")
def _(t):
    return sets.common_keys([t.game.where(c).select("game_id") for c in ("status = 'F'", "stage = 'regular'", "home_runs > 2")])


@query("split_overlap", "SELECT game_id FROM {game} WHERE season = 1998 AND home_runs > 3")
def _(t):
    return sets.split_overlap(t.game.where("season <= 1998"), t.game.where("season >= 1998 and home_runs > 3"))


@query("rows_changed", "SELECT v::BIGINT AS v, change FROM (SELECT v, 'removed' AS change FROM (SELECT home_runs AS v FROM {final} EXCEPT ALL SELECT away_runs FROM {final}) UNION ALL SELECT v, 'added' FROM (SELECT away_runs AS v FROM {final} EXCEPT ALL SELECT home_runs FROM {final}))")
def _(t):
    return sets.rows_changed(t.final.select(F.col("home_runs").alias("v")), t.final.select(F.col("away_runs").alias("v")))


# Scalars ---------------------------------------------------------------------------------------------------------


@query("monday_anchor", "SELECT event_id, CAST(date_trunc('week', ts) AS DATE) AS anchor FROM {events}")
def _(t):
    return t.events.select("event_id", scalars.monday_anchor(F.col("ts")).alias("anchor"))


@query("horizon_end", "SELECT anchor, anchor + 28 AS ends FROM {mondays}")
def _(t):
    return t.mondays.select("anchor", scalars.horizon_end(F.col("anchor"), 28).alias("ends"))


@query("status_enum", "SELECT game_id, CASE WHEN stage = 'postseason' THEN 'not evaluable' WHEN status = 'F' THEN 'confirmed' WHEN status = 'P' THEN 'predicted' WHEN home_runs > 3 THEN 'assumed' ELSE 'undetermined' END AS state FROM {game}")
def _(t):
    return t.game.select("game_id", scalars.status_enum(F.col("status") == "F", F.col("status") == "P", F.col("home_runs") > 3, F.col("stage") == "regular").alias("state"))


@query("null_not_zero", "SELECT event_id, round(plate_x, 6) AS value, CASE WHEN plate_x IS NULL THEN 'not measured' END AS reason FROM {pitch}")
def _(t):
    return t.pitch.select("event_id", scalars.null_not_zero(F.col("plate_x"), "not measured").alias("x")).select("event_id", "x.*")


@query("neg_log", "SELECT game_id, cls, round(-ln(greatest(p, 0.2)), 6) AS v FROM {preds}")
def _(t):
    return t.preds.select("game_id", "cls", scalars.neg_log(F.col("p"), 0.2).alias("v"))


@query("one_hot_sq", "SELECT p.game_id, p.cls, round(power(p.p - CASE WHEN p.cls = f.truth THEN 1 ELSE 0 END, 2), 6) AS v FROM {preds} p JOIN {final} f USING (game_id)")
def _(t):
    return t.preds.join(t.final, "game_id").select("game_id", "cls", scalars.one_hot_sq(F.col("p"), F.col("cls"), F.col("truth")).alias("v"))


@query("euclid", "SELECT event_id, round(sqrt(plate_x * plate_x + plate_z * plate_z), 6) AS d FROM {pitch}")
def _(t):
    return t.pitch.select("event_id", scalars.euclid(F.col("plate_x"), F.col("plate_z")).alias("d"))


@query("perspective_flip", "SELECT game_id, round(1 - p, 6) AS p FROM {preds} WHERE cls = 'H'")
def _(t):
    return t.preds.where("cls = 'H'").select("game_id", scalars.perspective_flip(F.col("p"), "win_share").alias("p"))


@query("round_score", "SELECT season::BIGINT AS season, round(avg(home_runs))::BIGINT AS score, 'mean_rounded' AS rule FROM {game} GROUP BY 1")
def _(t):
    return t.game.groupBy("season").agg(F.avg("home_runs").alias("m")).select("season", scalars.round_score(F.col("m")).alias("s")).select("season", "s.*")
