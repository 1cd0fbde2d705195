"""Planning as table jobs: transitions estimated from a log, value / policy iteration, reachability.

States and transitions are DataFrames; each sweep is one join of the static
transition table with the current value table plus two aggregations, so the
work per sweep grows with the number of transitions and runs on executors.
The transition table is an aggregate of the log: its size is bounded by the
distinct (state, action, next state) triples, whatever the log holds.
Value tables are checkpointed every sweep to keep lineage short.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..session import cut_lineage
from .carry import step_counts
from .ordering import ordinal

# fixed values of the studied planning problems
GAMMA = 0.25
THETA = 0.001
ITERATIONS = {"value_iteration": 20, "policy_iteration": 2, "q_learning": 50}   # default 100


def text_to_cells(lines: DataFrame, order_cols: Sequence[str], line_col: str) -> DataFrame:
    """Rows of text -> one row per character ``(x, y, kind)``: ``x`` counts from the left, ``y`` from the last line."""
    n = lines.count()
    rows = ordinal(lines.select(*order_cols, F.coalesce(F.col(line_col), F.lit("")).alias("_line")), order_cols, out="_i")
    chars = F.filter(F.split("_line", ""), lambda c: c != "")
    return rows.select((F.lit(n - 1) - F.col("_i")).alias("y"), F.posexplode(chars).alias("x", "kind")).select("x", "y", "kind")


def next_in_group(df: DataFrame, group: str, order_cols: Sequence[str], value: str, out: str) -> DataFrame:
    """``df`` with ``out`` = ``value`` of the group's next row (null for its last); a long group is many tasks."""
    pos = ordinal(df, order_cols, [group], out="_pos")
    nxt = pos.select(F.col(group).alias("_g"), (F.col("_pos") - 1).alias("_p"), F.col(value).alias(out))
    return pos.join(nxt, (F.col("_pos") == F.col("_p")) & F.col(group).eqNullSafe(F.col("_g")), "left").drop("_pos", "_p", "_g")


def estimate_transitions(log: DataFrame, group: str, order_cols: Sequence[str], s: str, a: str, r: str,
                         terminal: Column | None = None) -> DataFrame:
    """``(s, a, s2, p, r)`` from the logged steps of every group: relative frequencies, and the mean reward of each triple.

    A group's last step, and steps out of states where ``terminal`` (over ``s``) holds, are not transitions.
    """
    return transitions_of(step_counts(log, group, order_cols, s, a, r), terminal)


def transitions_of(counts: DataFrame, terminal: Column | None = None) -> DataFrame:
    steps = counts.where(F.col("s2").isNotNull())
    if terminal is not None:
        steps = steps.where(~F.coalesce(terminal, F.lit(False)))
    return steps.select("s", "a", "s2", (F.col("n") / F.sum("n").over(Window.partitionBy("s", "a"))).alias("p"), (F.col("rs") / F.col("n")).alias("r"))


def states_of(trans: DataFrame) -> DataFrame:
    return trans.select("s").unionByName(trans.select(F.col("s2").alias("s"))).distinct()


def _values_side(v: DataFrame) -> DataFrame:
    return v.select(F.col("s").alias("s2"), F.col("v").alias("_v2"))


def _q_values(trans: DataFrame, v: DataFrame, gamma: float) -> DataFrame:
    j = trans.join(_values_side(v), "s2", "left")
    return j.groupBy("s", "a").agg(F.sum(F.col("p") * (F.col("r") + gamma * F.coalesce(F.col("_v2"), F.lit(0.0))))
                                   .alias("q"))


def value_iteration(trans: DataFrame, states: DataFrame, gamma: float = GAMMA, theta: float = THETA,
                    max_iter: int = 100) -> DataFrame:
    """Synchronous Bellman sweeps from V = 0 until ``max |dV| < theta`` or ``max_iter``.

    Returns ``(s, v, sweeps)``.  Terminal states have no transitions and keep 0.
    Every sweep's value table is checkpointed: the plan stays one sweep deep
    (no re-analysis of a growing DAG) and a lost executor costs one sweep.
    """
    trans = cut_lineage(trans)
    states = cut_lineage(states)
    v = cut_lineage(states.select("s", F.lit(0.0).alias("v")))
    k = 0
    for k in range(1, max_iter + 1):
        # the previous value rides along, so the convergence check is a scan, not a second join
        best = _q_values(trans, v, gamma).groupBy("s").agg(F.max("q").alias("_nv"))
        nv = cut_lineage(v.join(best, "s", "left").select(
            "s", F.coalesce(F.col("_nv"), F.lit(0.0)).alias("v"), F.col("v").alias("_old")))
        delta = nv.agg(F.max(F.abs(F.col("v") - F.col("_old")))).first()[0] or 0.0
        v = nv.select("s", "v")
        if delta < theta:
            break
    return v.withColumn("sweeps", F.lit(k))


def greedy_policy(trans: DataFrame, v: DataFrame, gamma: float = GAMMA, digits: int = 9) -> DataFrame:
    """Argmax action per state from one-step look-ahead Q values; ties -> lowest action.

    Q is rounded to ``digits`` before the argmax so that sums that differ only
    in floating-point order do not flip a tie.
    """
    q = _q_values(trans, v, gamma)
    return q.groupBy("s").agg(F.max_by(F.struct("a", "q"), F.struct(F.round("q", digits).alias("_q"),
                                                                      (-F.col("a")).alias("_a"))).alias("_b")).select(
        "s", F.col("_b.a").alias("a"), F.col("_b.q").alias("q"))


def policy_iteration(trans: DataFrame, states: DataFrame, gamma: float = GAMMA, rounds: int = 2,
                     eval_sweeps: int = 20) -> DataFrame:
    """Rounds of (greedy improvement, ``eval_sweeps`` policy-evaluation sweeps), from V = 0, until the policy holds
    or ``rounds`` are done.

    Returns ``(s, v, a)`` with the final policy's action.
    """
    trans = cut_lineage(trans)
    states = cut_lineage(states)
    v = cut_lineage(states.select("s", F.lit(0.0).alias("v")))
    pol = None
    for _ in range(rounds):
        old, pol = pol, cut_lineage(greedy_policy(trans, v, gamma).select("s", "a"))
        if old is not None and pol.join(old.withColumnRenamed("a", "_a"), "s").where("a <> _a").isEmpty():
            break  # the values are those of this policy already
        tp = cut_lineage(trans.join(pol, ["s", "a"]))
        for _ in range(eval_sweeps):
            j = tp.join(_values_side(v), "s2", "left")
            ev = j.groupBy("s").agg(F.sum(F.col("p") * (F.col("r") + gamma * F.coalesce(F.col("_v2"), F.lit(0.0))))
                                    .alias("v"))
            v = cut_lineage(states.join(ev, "s", "left").select("s", F.coalesce(F.col("v"), F.lit(0.0)).alias("v")))
    final = greedy_policy(trans, v, gamma).select("s", "a")
    return v.join(final, "s", "left")


def reachable_states(trans: DataFrame, start, max_steps: int | None = None) -> DataFrame:
    """States reachable from ``start`` along transitions with ``p > 0`` (frontier BFS, directed).

    Each step joins only the new frontier with the edge table and anti-joins the
    visited set; both are checkpointed every step so the plan stays flat.
    """
    edges = cut_lineage(trans.where(F.col("p") > 0).select("s", "s2").distinct())
    kind = edges.schema["s"].dataType
    visited = cut_lineage(trans.sparkSession.range(1).select(F.lit(start).cast(kind).alias("s")))
    frontier = visited
    step = 0
    while True:
        step += 1
        nxt = frontier.join(edges, "s").select(F.col("s2").alias("s")).distinct()
        new = cut_lineage(nxt.join(visited, "s", "left_anti"))
        if new.isEmpty() or (max_steps is not None and step >= max_steps):
            break
        visited = cut_lineage(visited.unionByName(new))
        frontier = new
    return visited


def batch_q_learning(log: DataFrame, order_cols: Sequence[str], s: str, a: str, r: str, gamma: float = GAMMA,
                     q0: float = 0.3, lr: float = 0.1, sweeps: int = 10) -> DataFrame:
    """Fitted-Q sweeps over a log of steps in ``order_cols`` order.

    One pass over the log gives ``(s, a, s') -> (count, reward sum)``, whatever the log size; each sweep then
    updates ``Q <- (1-lr) Q + lr * mean(r + gamma * max_a' Q(s', a'))`` on that compact table.  The log's last step
    has no ``s'`` (no bootstrap term).
    """
    return fitted_q(step_counts(log, None, order_cols, s, a, r), gamma, q0, lr, sweeps)


def fitted_q(agg: DataFrame, gamma: float = GAMMA, q0: float = 0.3, lr: float = 0.1, sweeps: int = 10) -> DataFrame:
    """Fitted-Q sweeps over a table ``(s, a, s2, n, rs)`` of weights and reward sums.

    A sweep reads Q twice (its maxima and its old values), so Q is cut every sweep: the plan stays one sweep deep.
    """
    agg = cut_lineage(agg)
    q = agg.select("s", "a").distinct().withColumn("q", F.lit(float(q0)))
    for _ in range(sweeps):
        vmax = q.groupBy("s").agg(F.max("q").alias("_m")).withColumnRenamed("s", "s2")
        tgt = agg.join(vmax, "s2", "left").groupBy("s", "a").agg(
            ((F.sum("rs") + gamma * F.sum(F.col("n") * F.coalesce(F.col("_m"), F.lit(0.0)))) / F.sum("n")).alias("_t"))
        q = cut_lineage(q.join(tgt, ["s", "a"]).select("s", "a", ((1 - lr) * F.col("q") + lr * F.col("_t")).alias("q")))
    return q


# strategy registry: name -> callable(trans, states, budget) returning a value / Q table
PLANNERS = {
    "value_iteration": lambda trans, states, budget, **kw: value_iteration(trans, states, max_iter=budget, **kw),
    "policy_iteration": lambda trans, states, budget, **kw: policy_iteration(trans, states, rounds=budget, **kw),
    "q_learning": lambda trans, states, budget, **kw: fitted_q(
        trans.select("s", "a", "s2", F.col("p").alias("n"), (F.col("p") * F.col("r")).alias("rs")), sweeps=budget, **kw),
}


def run_planner(name: str, trans: DataFrame, states: DataFrame, budget: int | None = None, **kw) -> DataFrame:
    """Look up a planner by name; the budget defaults to the per-algorithm iteration count (else 100)."""
    return PLANNERS[name](trans, states, budget if budget is not None else ITERATIONS.get(name, 100), **kw)


def connected_components(edges: DataFrame, max_rounds: int = 200) -> DataFrame:
    """Component label (smallest node id) of every node of an undirected graph ``(u, v)``.

    Alternating large-star / small-star rounds (Kiveris et al., "Connected
    Components in MapReduce and Beyond", SoCC 2014): O(log^2 n) rounds, each a
    group-by-min plus a join, with no per-node neighbour lists collected.  The
    edge table is checkpointed every round.
    """
    e = edges.select(F.col("u").cast("long"), F.col("v").cast("long"))
    e = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v"))).where(F.col("u") != F.col("v")).distinct()
    nodes = cut_lineage(edges.select(F.col("u").cast("long").alias("n")).unionByName(
        edges.select(F.col("v").cast("long").alias("n"))).distinct())
    e = cut_lineage(e)

    def both(df):
        return df.unionByName(df.select(F.col("v").alias("u"), F.col("u").alias("v"))) \
            .where(F.col("u") != F.col("v")).distinct()

    prev = None
    for _ in range(max_rounds):
        # large star: connect every larger neighbour of u to the minimum of u's closed neighbourhood
        m = e.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        ls = e.where(F.col("v") > F.col("u")).join(m, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = cut_lineage(both(ls))
        # small star: connect u and its smaller neighbours to the minimum of them
        sm = e.where(F.col("v") <= F.col("u"))
        m2 = sm.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        ss = sm.join(m2, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            m2.select("u", F.col("m").alias("v")))
        e = cut_lineage(both(ss))
        sig = e.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))"), F.min("v"), F.max("v")).first()
        if prev is not None and tuple(sig) == prev:
            break
        prev = tuple(sig)
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    label = e.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("label"))
    return nodes.join(label.withColumnRenamed("u", "n"), "n", "left").select(
        F.col("n").alias("node"), F.coalesce(F.col("label"), F.col("n")).alias("label"))
