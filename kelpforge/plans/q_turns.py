"""Turn analytics over conversations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kelpforge.operators.checks import issues
from kelpforge.functions.scores import observation_score, selection_score
from kelpforge.operators.turns import answered_call, last_observation, latest_before, native_history, state_by_length, merge_intervals, prefix_samples, role_sequences, running_count, transitions
from kelpforge.plans.catalog import query
from kelpforge.session import table

_PAST = "OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"


def _turns(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "conversations")


@query(
    "turn_state",
    f"SELECT conv_id, turn, a AS assistants_before, u AS users_before, CASE WHEN role = 'assistant' AND a = 0 THEN 'first_answer' WHEN role = 'assistant' AND a = 1 THEN 'second_answer' "
    f"WHEN role = 'assistant' THEN 'later_answer' WHEN role = 'user' AND u = 0 THEN 'first_ask' WHEN role = 'user' THEN 'later_ask' ELSE 'other' END AS state "
    f"FROM (SELECT *, CAST(coalesce(sum(CASE WHEN role = 'assistant' THEN 1 ELSE 0 END) {_PAST}, 0) AS BIGINT) AS a, CAST(coalesce(sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) {_PAST}, 0) AS BIGINT) AS u FROM conversations)",
)
def turn_state(spark: SparkSession, sf: str) -> DataFrame:
    t = _turns(spark, sf).select("conv_id", "turn", "role")
    t = t.withColumns({"assistants_before": running_count(F.col("role") == "assistant"), "users_before": running_count(F.col("role") == "user")})
    a, u, r = F.col("assistants_before"), F.col("users_before"), F.col("role")
    state = F.when((r == "assistant") & (a == 0), "first_answer").when((r == "assistant") & (a == 1), "second_answer").when(r == "assistant", "later_answer").when((r == "user") & (u == 0), "first_ask").when(r == "user", "later_ask").otherwise("other")
    return t.select("conv_id", "turn", "assistants_before", "users_before", state.alias("state"))


@query(
    "prefix_samples",
    f"SELECT conv_id || ':m' || turn AS sample_id, sha256(h) AS history_sha256, n AS history_turns FROM (SELECT conv_id, turn, role, coalesce(string_agg(role || ':' || text, chr(10) ORDER BY turn) {_PAST}, '') AS h, count(*) {_PAST} AS n FROM conversations) WHERE role = 'assistant'".replace("ORDER BY turn) OVER", ") OVER"),
)
def prefix_samples_query(spark: SparkSession, sf: str) -> DataFrame:
    p = prefix_samples(_turns(spark, sf))
    return p.select("sample_id", F.sha2(F.array_join("history", "\n"), 256).alias("history_sha256"), F.size("history").cast("long").alias("history_turns"))


@query(
    "previous_of_role",
    f"SELECT conv_id, turn, last_value(CASE WHEN role = 'user' THEN text END IGNORE NULLS) {_PAST} AS last_ask FROM conversations",
)
def previous_of_role(spark: SparkSession, sf: str) -> DataFrame:
    return _turns(spark, sf).select("conv_id", "turn", latest_before(F.col("role") == "user", F.col("text")).alias("last_ask"))


@query(
    "transitions",
    "SELECT kind, next_kind, count(*) AS n FROM (SELECT role AS kind, lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS next_kind FROM conversations) GROUP BY ALL",
)
def transitions_query(spark: SparkSession, sf: str) -> DataFrame:
    return transitions(_turns(spark, sf))


@query(
    "role_sequence",
    "SELECT roles, count(*) AS n FROM (SELECT string_agg(left(role, 1), '' ORDER BY turn) AS roles FROM conversations GROUP BY conv_id) GROUP BY roles",
)
def role_sequence(spark: SparkSession, sf: str) -> DataFrame:
    return role_sequences(_turns(spark, sf)).groupBy("roles").agg(F.count(F.lit(1)).alias("n"))


@query(
    "terminal_turn",
    "SELECT conv_id, arg_max(role, turn) AS last_role, max(turn) AS last_turn, arg_max(role, turn) = 'assistant' AS complete FROM conversations GROUP BY conv_id",
)
def terminal_turn(spark: SparkSession, sf: str) -> DataFrame:
    g = _turns(spark, sf).groupBy("conv_id").agg(F.max_by("role", "turn").alias("last_role"), F.max("turn").alias("last_turn"))
    return g.withColumn("complete", F.col("last_role") == "assistant")


_WITH_GAP = "(SELECT conv_id, turn, role FROM conversations WHERE NOT (conv_id = 3 AND turn = 1) UNION ALL SELECT 5, 0, 'user')"


@query(
    "turn_gap_issues",
    f"SELECT conv_id, turn, 'gap' AS code, 'P0' AS severity FROM (SELECT *, lag(turn) OVER (PARTITION BY conv_id ORDER BY turn) AS p FROM {_WITH_GAP}) WHERE turn > p + 1 "
    f"UNION ALL SELECT conv_id, turn, 'repeated', 'P0' FROM (SELECT *, lag(turn) OVER (PARTITION BY conv_id ORDER BY turn) AS p FROM {_WITH_GAP}) WHERE turn = p",
)
def turn_gap_issues(spark: SparkSession, sf: str) -> DataFrame:
    t = _turns(spark, sf).select("conv_id", "turn", "role").where("NOT (conv_id = 3 AND turn = 1)")  # two planted faults: a gap and a repeat
    t = t.unionByName(spark.createDataFrame([(5, 0, "user")], "conv_id long, turn long, role string"))
    p = t.withColumn("p", F.lag("turn").over(Window.partitionBy("conv_id").orderBy("turn")))
    found = issues(p.withColumn("at", F.struct("conv_id", "turn")), "at", [("gap", "P0", F.col("turn") > F.col("p") + 1), ("repeated", "P0", F.col("turn") == F.col("p"))])
    return found.select("at.conv_id", "at.turn", "code", "severity")


@query(
    "interval_merge",
    "WITH e AS (SELECT user_id, CAST(floor(epoch(ts)) AS BIGINT) AS s, CAST(floor(epoch(ts)) AS BIGINT) + 600 AS e FROM events), "
    "m AS (SELECT *, CASE WHEN s > max(e) OVER (PARTITION BY user_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 1 ELSE 0 END AS n FROM e), "
    "g AS (SELECT *, sum(n) OVER (PARTITION BY user_id ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS i FROM m) "
    "SELECT user_id, min(s) AS island_start, max(e) AS island_end, count(*) AS n FROM g GROUP BY user_id, i",
)
def interval_merge(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").select("user_id", F.unix_seconds(F.col("ts").cast("timestamp")).alias("s"))
    return merge_intervals(e.withColumn("e", F.col("s") + 600), "user_id", "s", "e")


#: Stand-in tools of the conversations: an assistant's turn submits, a user's turn runs.
_TOOL = "CASE WHEN role = 'assistant' THEN 'submit' ELSE 'run_candidate' END"


@query(
    "state_by_length",
    f"SELECT conv_id, turn, CASE WHEN n = 2 AND t = 'submit' THEN 'problem_submit' WHEN n = 4 AND t = 'run_candidate' THEN 'first_failure_run' WHEN n = 4 AND t = 'submit' THEN 'first_failure_direct_repair' "
    f"WHEN n = 6 AND t = 'submit' THEN 'post_run_repair' WHEN n = 8 AND t = 'run_candidate' THEN 'second_failure_run' WHEN n = 10 AND t = 'submit' THEN 'multiround_final_submit' ELSE 'other' END AS state "
    f"FROM (SELECT conv_id, turn, turn + 1 AS n, {_TOOL} AS t FROM conversations)",
)
def state_by_length_query(spark: SparkSession, sf: str) -> DataFrame:
    return _turns(spark, sf).select("conv_id", "turn", state_by_length(F.col("turn") + 1, F.expr(_TOOL)).alias("state"))


@query(
    "answered_call",
    "SELECT conv_id, turn, CASE WHEN role = 'assistant' AND lag(role) OVER w = 'user' THEN sha256(lag(text) OVER w) END AS call_sha256 FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)",
)
def answered_call_query(spark: SparkSession, sf: str) -> DataFrame:
    call = answered_call(F.col("role") == "assistant", F.col("role") == "user", F.sha2("text", 256))
    return _turns(spark, sf).select("conv_id", "turn", call.alias("call_sha256"))


@query(
    "history_shape",
    """WITH r AS (SELECT *, count(*) OVER (PARTITION BY conv_id) AS n, lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS nx,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS back FROM conversations),
    f AS (SELECT conv_id, min(turn) AS t FROM r WHERE role = 'assistant' AND nx IS NOT NULL GROUP BY conv_id)
    SELECT r.conv_id, max(CASE WHEN back = 2 AND role = 'user' THEN sha256(text) END) AS observed_sha256,
    coalesce(max(CASE WHEN r.turn = f.t AND length(text) < 400 AND nx = 'user' THEN 1 ELSE 0 END), 0) = 1 AS native
    FROM r LEFT JOIN f USING (conv_id) GROUP BY r.conv_id""",
)
def history_shape(spark: SparkSession, sf: str) -> DataFrame:
    """A user's turn stands for a tool's answer to a submit, a long assistant's turn for a trainable one."""
    user = F.col("role") == "user"
    turn = F.struct(
        "turn",
        F.when(user, "observation").otherwise("function_call").alias("from"),
        F.col("text").alias("value"),
        F.when(user, "tool").otherwise(F.col("role")).alias("role"),
        F.lit("submit").alias("name"),
        (F.length("text") >= 400).alias("trainable"),
    )
    t = _turns(spark, sf).groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("m"))
    return t.select("conv_id", F.sha2(last_observation(F.col("m")), 256).alias("observed_sha256"), native_history(F.col("m")).alias("native"))


_OBS = "CASE o_orderstatus WHEN 'F' THEN 'ok' WHEN 'O' THEN 'runtime_error' ELSE 'timeout' END"
_ERR = "CASE WHEN o_orderpriority < '3' THEN 'IndexError: x' ELSE 'killed' END"


@query(
    "selection_scores",
    f"""WITH o AS (SELECT *, {_OBS} AS s, {_ERR} AS e, o_totalprice > 400000 AS cut, CAST(floor(o_totalprice / 200) AS BIGINT) AS tokens,
    CASE WHEN o_orderpriority < '2' THEN 'problem_submit' WHEN o_orderpriority < '3' THEN 'second_failure_run' ELSE 'other' END AS st FROM orders),
    c AS (SELECT *, CASE WHEN cut THEN -2 WHEN s = 'ok' THEN 1 WHEN s = 'timeout' THEN -1 WHEN s = 'runtime_error' AND e LIKE 'IndexError%' THEN 1 ELSE 0 END AS obs FROM o)
    SELECT o_orderkey, CAST(obs AS INTEGER) AS observation, CAST(
    (CASE WHEN st = 'second_failure_run' THEN 5 ELSE 0 END) + (CASE WHEN st = 'problem_submit' THEN 1 ELSE 0 END) + (CASE WHEN tokens < 500 THEN 1 ELSE 0 END)
    - (CASE WHEN tokens > 1000 THEN 3 ELSE 0 END) - (CASE WHEN s = 'timeout' THEN 1 ELSE 0 END) + (CASE WHEN st = 'problem_submit' THEN -2 ELSE obs END) AS DOUBLE) AS score FROM c""",
)
def selection_scores(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").withColumns({"s": F.expr(_OBS), "e": F.expr(_ERR), "tokens": F.floor(F.col("o_totalprice") / 200)})
    state = F.when(F.col("o_orderpriority") < "2", "problem_submit").when(F.col("o_orderpriority") < "3", "second_failure_run").otherwise("other")
    seen = observation_score(F.col("s"), F.col("o_totalprice") > 400000, F.lit(None).cast("int"), F.col("e"), F.lit(""))
    tool = F.when(state == "second_failure_run", "run_candidate").otherwise("submit")
    hard = F.when(F.col("s") == "timeout", "competition").otherwise("interview")
    return o.select("o_orderkey", seen.alias("observation"), selection_score(tool, state, F.col("tokens"), hard, F.lit(2), seen).alias("score"))
