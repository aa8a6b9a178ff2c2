"""Building hierarchy as an adjacency list.

The transitive closure is built level by level with joins (a tree of depth L
takes L joins); it has one row per (ancestor, descendant) pair along a path,
i.e. nodes x depth rows -- never all pairs of a level.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlake.functions.text import floor_code
from sensorlake.operators.util import DEFAULT_BROADCAST_ROWS, bounded_broadcast
from sensorlake.session import materialize


def hierarchy_from_locations(df: DataFrame, building: str, location_col: str = "location",
                             sensor_col: str | None = None) -> DataFrame:
    """Building -> floor -> zone (-> sensor) from location codes (`1NP-S1`: floor `1NP`).

    With ``sensor_col`` (e.g. the indoor sensor map: sensor, location) every
    distinct sensor becomes a leaf under its zone.
    """
    locs = df.select(F.col(location_col).alias("zone")).filter(F.col("zone").isNotNull()).distinct()
    floors = locs.select(floor_code("zone").alias("floor")).distinct()
    root = df.sparkSession.createDataFrame([(building, None, "building", building, 0)],
                                           "id string, parent_id string, type string, name string, level int")
    fl = floors.select(F.concat_ws("/", F.lit(building), "floor").alias("id"), F.lit(building).alias("parent_id"),
                       F.lit("floor").alias("type"), F.col("floor").alias("name"), F.lit(1).alias("level"))
    zn = locs.select(F.concat_ws("/", F.lit(building), floor_code("zone"), "zone").alias("id"),
                     F.concat_ws("/", F.lit(building), floor_code("zone")).alias("parent_id"),
                     F.lit("zone").alias("type"), F.col("zone").alias("name"), F.lit(2).alias("level"))
    out = root.unionByName(fl).unionByName(zn)
    if sensor_col:
        zone_id = F.concat_ws("/", F.lit(building), floor_code(location_col), F.col(location_col))
        sn = (df.filter(F.col(sensor_col).isNotNull() & F.col(location_col).isNotNull())
                .select(F.col(sensor_col).alias("_s"), zone_id.alias("parent_id")).distinct()
                .select(F.concat_ws("/", "parent_id", "_s").alias("id"), "parent_id", F.lit("sensor").alias("type"),
                        F.col("_s").alias("name"), F.lit(3).alias("level")))
        out = out.unionByName(sn)
    return out


def _walk(frontier: DataFrame, edges: DataFrame, down: bool, max_depth: int | None) -> DataFrame:
    """Every level from ``frontier`` (ancestor, descendant, depth, path) along ``edges`` (_from, _to, _name).

    Each level is computed once and written to the checkpoint folder. A
    node that comes up twice on one trail is a cycle and raises.
    """
    end = "descendant" if down else "ancestor"
    frontier = materialize(frontier.withColumn("_trail", F.array(end)))
    levels = [frontier]
    while True:
        names = ("path", "_name") if down else ("_name", "path")
        step = frontier.join(edges, F.col(end) == F.col("_from")).select(
            *[F.col("_to").alias(c) if c == end else F.col(c) for c in ("ancestor", "descendant")],
            (F.col("depth") + 1).alias("depth"), F.concat(F.col(names[0]), F.lit("/"), F.col(names[1])).alias("path"),
            F.concat("_trail", F.array("_to")).alias("_trail"), F.array_contains("_trail", F.col("_to")).alias("_loop"))
        step = materialize(step)
        state = step.agg(F.count("*").alias("n"), F.max("_loop").alias("loop")).first()
        if not state["n"]:
            break
        if state["loop"] or (max_depth is not None and len(levels) > max_depth):
            raise ValueError(f"hierarchy cyclic or deeper than {max_depth} levels")
        frontier = step.drop("_loop")
        levels.append(frontier)
    return functools.reduce(DataFrame.unionByName, levels).drop("_trail")


def _chosen(nodes: DataFrame, ids: DataFrame | Sequence[str] | None) -> DataFrame:
    if ids is None:
        return nodes
    if isinstance(ids, DataFrame):
        return nodes.join(ids.select(F.col(ids.columns[0]).alias("id")), "id", "left_semi")
    return nodes.filter(F.col("id").isin(list(ids)))


def _start(nodes: DataFrame) -> DataFrame:
    return nodes.select(F.col("id").alias("ancestor"), F.col("id").alias("descendant"), F.lit(0).alias("depth"),
                        F.col("name").alias("path"))


def _nodes(h: DataFrame) -> DataFrame:
    return h.select("id", "parent_id", F.col("name").cast("string").alias("name"))


def closure(h: DataFrame, max_depth: int | None = None, roots: DataFrame | Sequence[str] | None = None) -> DataFrame:
    """(ancestor, descendant, depth, path) for every node and each of its ancestors (itself at depth 0).

    Built level by level: each step joins the current frontier (pairs whose
    descendant is at distance k) to the children of its descendants. A tree
    of depth L takes L joins; the result has nodes x depth rows, with no
    recursion row limit. With ``roots`` the walk starts from those nodes
    only. A cycle raises, as does a tree deeper than ``max_depth`` if given.
    """
    nodes = _nodes(h)
    children = nodes.filter(F.col("parent_id").isNotNull()).select(
        F.col("parent_id").alias("_from"), F.col("id").alias("_to"), F.col("name").alias("_name"))
    return _walk(_start(_chosen(nodes, roots)), children, True, max_depth)


def upward(h: DataFrame, ids: DataFrame | Sequence[str], max_depth: int | None = None) -> DataFrame:
    """The rows of ``closure`` whose descendant is one of ``ids``, found by walking up from them."""
    nodes = _nodes(h)
    above = nodes.select(F.col("id").alias("_to"), F.col("name").alias("_name"))
    parents = nodes.filter(F.col("parent_id").isNotNull()).select(F.col("id").alias("_from"), F.col("parent_id").alias("_to"))
    return _walk(_start(_chosen(nodes, ids)), parents.join(above, "_to"), False, max_depth)


def descendants(h: DataFrame, roots: DataFrame | Sequence[str] | None = None) -> DataFrame:
    """Nodes under each root (depth >= 1) with depth and path; only what lies under the roots is visited."""
    return closure(h, roots=roots).filter(F.col("depth") >= 1)


def ancestors(h: DataFrame, nodes: DataFrame | Sequence[str] | None = None) -> DataFrame:
    """Ancestors of each node (depth >= 1 = hops up); only the way up from the nodes is visited."""
    return (closure(h) if nodes is None else upward(h, nodes)).filter(F.col("depth") >= 1)


def siblings(h: DataFrame) -> DataFrame:
    """H03 / J10 (re-aimed): per node, its parent and the number of siblings.

    Emitting every sibling pair grows with the square of a parent's fan-out;
    the pair list is available per requested node via ``siblings_of``.
    """
    counts = h.filter(F.col("parent_id").isNotNull()).groupBy("parent_id").agg(F.count(F.lit(1)).alias("_n"))
    return (h.join(counts, "parent_id", "left")
             .select("id", "parent_id", "type", F.coalesce(F.col("_n") - 1, F.lit(0)).alias("n_siblings")))


def siblings_of(h: DataFrame, nodes: DataFrame) -> DataFrame:
    """Sibling list of the requested nodes only (first column of ``nodes`` = ids)."""
    req = nodes.select(F.col(nodes.columns[0]).alias("node")).distinct()
    req = req.join(h.select(F.col("id").alias("node"), F.col("parent_id").alias("_p")), "node")
    sib = h.select(F.col("id").alias("sibling"), F.col("parent_id").alias("_p"))
    return req.join(sib, "_p").filter(F.col("node") != F.col("sibling")).select("node", F.col("_p").alias("parent_id"),
                                                                                   "sibling")


def path(h: DataFrame, pairs: DataFrame | str, b: str | None = None) -> DataFrame:
    """Path between node pairs (columns a, b) through their lowest common
    ancestor; ``path(h, "a_id", "b_id")`` asks for one pair."""
    if isinstance(pairs, str):
        pairs = h.sparkSession.createDataFrame([(pairs, b)], "a string, b string")
    c = materialize(upward(h, pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()))
    ca = c.select(F.col("descendant").alias("a"), "ancestor", F.col("depth").alias("up_a"))
    cb = c.select(F.col("descendant").alias("b"), "ancestor", F.col("depth").alias("up_b"))
    j = pairs.select("a", "b").join(ca, "a").join(cb, ["b", "ancestor"])
    best = j.groupBy("a", "b").agg(F.min_by(F.struct("ancestor", "up_a", "up_b"), F.col("up_a") + F.col("up_b")).alias("_m"))
    return best.select("a", "b", F.col("_m.ancestor").alias("lca"), F.col("_m.up_a").alias("up_a"),
                       F.col("_m.up_b").alias("up_b"), (F.col("_m.up_a") + F.col("_m.up_b")).alias("hops"))


def readings_with_hierarchy(df: DataFrame, h: DataFrame, node_col: str = "node",
                            max_broadcast_rows: int | None = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Readings joined to every ancestor of their node (one row per reading and level).

    The closure (nodes x depth rows, typed with the ancestor's kind) is the
    side that gets broadcast when its size bound holds, so a sensor with a
    huge share of the readings does not skew a shuffle join.
    """
    names = h.select(F.col("id").alias("ancestor"), F.col("type").alias("ancestor_type"))
    anc = closure(h).select(F.col("descendant").alias(node_col), "ancestor", "depth").join(names, "ancestor")
    return df.join(bounded_broadcast(anc, max_broadcast_rows), node_col)
