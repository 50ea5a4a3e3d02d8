"""Graph operators: connected components, map resolution, walks over parent/child edges."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainmill.session import materialize


def _star(large: bool):
    """Scans directed edges (u, v, moved) sorted by u and v, where m is the least neighbour of u.

    The large star (all edges, both ways) links the greater neighbours of u with the lesser of u and m; the small star
    (edges to lesser nodes) links u and its other neighbours with m. Should a node's edges be split over partitions,
    each links with its own m and with u, so nothing falls apart. Memory is one batch, whatever a node's degree.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_u = last_v = least = None
        for b in batches:
            if not b.num_rows:
                continue
            u, v, moved = (b.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            new, again = np.ones(len(u), bool), np.zeros(len(u), bool)
            new[1:] = u[1:] != u[:-1]
            again[1:] = ~new[1:] & (v[1:] == v[:-1])
            if last_u == u[0]:
                new[0], again[0] = False, v[0] == last_v
            at = np.maximum.accumulate(np.where(new, np.arange(len(u)), -1))
            m = np.where(at < 0, v[0] if least is None else least, v[np.maximum(at, 0)])
            last_u, last_v, least = u[-1], v[-1], m[-1]
            if large:
                m = np.minimum(u, m)
                keep = ~again & (v > u)
                out = v[keep], m[keep], (m < u)[keep]
            else:
                keep = ~again
                other = (v != m)[keep]
                out = np.where(other, v[keep], u[keep]), m[keep], moved[keep] | other
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in out], names=["u", "v", "moved"])

    return run


def _round(edges: DataFrame) -> DataFrame:
    """One large star and one small star: two exchanges. Hot nodes are split where the exchange is rebalanced."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"), "moved"))
    schema = "u long, v long, moved boolean"
    large = both.hint("rebalance", "u").sortWithinPartitions("u", "v").mapInArrow(_star(True), schema)
    return large.hint("rebalance", "u").sortWithinPartitions("u", "v").mapInArrow(_star(False), schema)


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Rows (node, component) for every node of an undirected edge list of integer ids; component is its least node.

    Alternating large-star and small-star rounds until nothing moves; each is one job that writes one table to the
    shared folder, and their number grows with the logarithm of the longest path. Self loops give a component of their
    own, null ends are ignored, repeated edges count once. Nodes of very high degree are scanned, never collected. Only
    whether anything moved reaches the driver.
    """
    clean = edges.select(F.col(src).cast("long").alias("a"), F.col(dst).cast("long").alias("b")).where("a is not null and b is not null")
    nodes = clean.where("a = b").select(F.col("a").alias("node"), F.col("a").alias("component"))
    cur = clean.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"), F.lit(False).alias("moved"))
    while True:
        cur = materialize(_round(cur.withColumn("moved", F.lit(False))), "edges")
        if not cur.where("moved").limit(1).count():
            break
    stars = cur.select("u", "v").distinct()
    roots = cur.select(F.col("v").alias("node")).distinct()
    found = stars.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots.select("node", F.col("node").alias("component")))
    return found.unionByName(nodes.join(found, "node", "left_anti").distinct())


def resolve_map(pairs: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Rows (src, dst): every key followed along the map to the end of its chain, by pointer jumping.

    A chain that runs into a cycle stops at the least value of that cycle. Keys must be unique; null keys and
    values are left out.
    """
    cur = materialize(pairs.select(F.col(src).alias("s"), F.col(dst).alias("d")).where("s is not null and d is not null and s <> d"), "map")
    # a cycle has no end: walk with the set of values seen and cut it at its least member
    cyc = _cycle_members(cur)
    cur = materialize(cur.join(cyc, "s", "left").select("s", F.coalesce("least", "d").alias("d")).where("s <> d"), "map")
    while True:
        nxt = materialize(
            cur.join(cur.select(F.col("s").alias("d"), F.col("d").alias("e")), "d", "left").select("s", F.coalesce("e", "d").alias("d"), F.col("e").isNotNull().alias("moved")),
            "map",
        )
        moved = nxt.where("moved").limit(1).count()
        cur = nxt.drop("moved")
        if not moved:
            break
    return cur.select(F.col("s").alias(src), F.col("d").alias(dst))


def _cycle_members(cur: DataFrame) -> DataFrame:
    """(s, least): members of cycles of a map with the least member of their cycle."""
    # members survive taking away, again and again, keys that no value points at
    core, n = cur, -1
    while True:
        core = materialize(core.join(core.select(F.col("d").alias("s")).distinct(), "s", "left_semi").join(core.select(F.col("s").alias("d")), "d", "left_semi").select("s", "d"), "core")
        m = core.count()
        if m == n or m == 0:
            break
        n = m
    least = core.withColumn("least", F.least("s", "d"))
    while n > 0:
        nxt = materialize(
            least.alias("a")
            .join(least.select(F.col("s").alias("k"), F.col("least").alias("l2"), F.col("d").alias("d2")), F.col("a.d") == F.col("k"))
            .select("s", F.col("d2").alias("d"), F.least("least", "l2").alias("least")),
            "core",
        )
        same = nxt.select("s", "least").exceptAll(least.select("s", "least")).limit(1).count()
        least = nxt
        if not same:
            break
    return least.select("s", "least")


def walks(nodes: DataFrame, edges: DataFrame, name: str = "name", src: str = "src", dst: str = "dst") -> DataFrame:
    """(base, at, path): every node reached from every root (a node nothing points at), with the way there.

    A walk ends where it would meet a node it already holds, so cycles end; cycles without a root are not reached.
    """
    e = edges.select(F.col(src).alias("s"), F.col(dst).alias("d")).where("s is not null and d is not null").distinct()
    roots = nodes.select(F.col(name).alias("base")).distinct().join(e.select(F.col("d").alias("base")), "base", "left_anti")
    front = materialize(roots.select("base", F.col("base").alias("at"), F.array("base").alias("seen")), "walk")
    out = front
    while True:
        front = materialize(front.join(e, front["at"] == e["s"]).where(~F.array_contains("seen", F.col("d"))).select("base", F.col("d").alias("at"), F.concat("seen", F.array("d")).alias("seen")), "walk")
        if not front.limit(1).count():
            break
        out = out.unionByName(front)
    return out.select("base", "at", F.array_join("seen", " > ").alias("path"))


def chains(nodes: DataFrame, edges: DataFrame, name: str = "name", src: str = "src", dst: str = "dst") -> DataFrame:
    """(base, final, path): the walks that end in a node without a further edge."""
    w = walks(nodes, edges, name, src, dst)
    return w.join(edges.select(F.col(src).alias("at")), "at", "left_anti").select("base", F.col("at").alias("final"), "path")


def tree_edges(df: DataFrame, tree: str, name: str, children: str, depth: int) -> DataFrame:
    """(src, dst) of JSON trees down to a depth: each node's name with those of its children."""
    level = df.select(F.parse_json(tree).alias("t"))
    out = None
    for _ in range(depth):
        kids = level.select(
            F.try_variant_get("t", f"$.{name}", "string").alias("src"),
            F.explode(F.try_variant_get("t", f"$.{children}", "array<variant>")).alias("t"),
        )
        here = kids.select("src", F.try_variant_get("t", f"$.{name}", "string").alias("dst"))
        out = here if out is None else out.unionByName(here)
        level = kids.select("t")
    return out
