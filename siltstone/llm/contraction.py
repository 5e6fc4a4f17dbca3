"""Connected components by random contraction of a graph, as joins and aggregations only.

Two ways to choose what contracts in a round:

* `hash_order`: each vertex hooks to the member of its closed neighbourhood that comes first in a fresh hash order
  (Bögeholz, Brand and Todor, "In-database connected component analysis", 2020).
* `random_mate`: each vertex tosses a coin; one with tails hooks to its least neighbour with heads, if it has one.

Either relabels the edges by the hooks, drops loops and repeats, until no edge is left; the rounds' mappings are then
unwound from the last to the first. A round shrinks the vertices that still have edges by a constant expected factor,
whatever the shape: long chains take O(log n) rounds, not as many as they are long. A hub with a third of all edges is
aggregated on the map side (`min`), and the joins that relabel carry one row per vertex on the mapping's side, which
AQE's skew handling splits on the edges' side.

Each round is written to the shared folder, so a lost executor costs at most a task of the current round.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.runtime import cut, drop

#: A contraction shrinks by a constant expected factor a round; this many rounds are never reached but by an error.
MAX_ROUNDS = 200


class _Draw:
    """The fresh hash order and the coins of one round."""

    def __init__(self, seed: int, turn: int):
        self.salt = f"{seed}:{turn}"

    def order(self, vertex: str) -> Column:
        return F.xxhash64(F.lit(self.salt), F.col(vertex))

    def heads(self, vertex: str) -> Column:
        return F.pmod(F.shiftright(self.order(vertex), 17), F.lit(2)) == 0


def _hash_order(edges: DataFrame, draw: _Draw) -> DataFrame:
    first = F.min(F.struct(draw.order("w").alias("h"), F.col("w").alias("r"))).alias("m")
    own = F.struct(draw.order("v").alias("h"), F.col("v").alias("r"))
    return edges.groupBy("v").agg(first).select("v", F.least(own, F.col("m"))["r"].alias("r")).filter("r <> v")


def _random_mate(edges: DataFrame, draw: _Draw) -> DataFrame:
    return edges.filter(~draw.heads("v") & draw.heads("w")).groupBy("v").agg(F.min("w").alias("r"))


METHODS = {"hash_order": _hash_order, "random_mate": _random_mate}


def components(edges: DataFrame, left: str, right: str, method: str = "hash_order", seed: int = 1) -> DataFrame:
    """(v, root): for every vertex of `edges` with an edge to another one, a vertex that stands for its component.

    Rows with a null end and loops make no edge; a vertex with no other edge does not come out (it is its own
    component). Repeated and mirrored edges count once. Other columns are ignored. `root` is the same for exactly the
    vertices that are linked directly or indirectly; which of them it is depends on `seed`.
    """
    pairs = edges.select(F.col(left).alias("v"), F.col(right).alias("w")).filter("v <> w")
    # both directions of each edge once
    pairs = pairs.select(F.least("v", "w").alias("v"), F.greatest("v", "w").alias("w")).distinct()
    ends = F.explode(F.array(F.struct("v", "w"), F.struct(F.col("w").alias("v"), F.col("v").alias("w"))))
    now = cut(pairs.select(ends.alias("e")).select("e.*"), "edges")
    rounds: list[DataFrame] = []
    for turn in range(MAX_ROUNDS):
        if now.isEmpty():
            break
        hooks = cut(METHODS[method](now, _Draw(seed, turn)), "hooks")
        rounds.append(hooks)
        to_v, to_w = hooks.select("v", "r"), hooks.select(F.col("v").alias("w"), F.col("r").alias("s"))
        moved = (
            now.join(to_v, "v", "left")
            .select(F.coalesce("r", "v").alias("v"), "w")
            .join(to_w, "w", "left")
            .select("v", F.coalesce("s", "w").alias("w"))
            .filter("v <> w")
            .distinct()
        )
        after = cut(moved, "edges")
        drop(now)
        now = after
    else:
        raise RuntimeError(f"edges are left after {MAX_ROUNDS} rounds")
    roots: DataFrame | None = None
    before: list[DataFrame] = []
    for hooks in reversed(rounds):
        if roots is None:
            before = [hooks]
            roots = hooks.select("v", F.col("r").alias("root"))
            continue
        # a root of later rounds hooks no earlier; whoever hooked in this round takes the root of what it hooked to
        later = roots.select(F.col("v").alias("r"), "root")
        moved = hooks.join(later, "r", "left").select("v", F.coalesce("root", "r").alias("root"))
        # a name can hook and yet live on as another's label: both rows then say the same
        unwound = cut(roots.unionByName(moved).distinct(), "roots")
        drop(hooks, *before)
        roots, before = unwound, [unwound]
    if roots is None:
        return now.select("v", F.col("w").alias("root"))
    # those that never hooked stand for themselves
    return roots.unionByName(roots.select("root").distinct().select(F.col("root").alias("v"), "root")).distinct()
