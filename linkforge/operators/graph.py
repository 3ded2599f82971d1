"""Graph stage: connected components of the match graph and cluster tables.

Connected components use the alternating large-star / small-star rounds
of Kiveris et al. (2014): O(log^2 n) rounds, each a few aggregations and
joins over the edge list (five shuffles per round). No node's neighbourhood
is ever gathered into one row: every per-node quantity is a ``min``/``count``
aggregate, which Spark combines map-side. The edges of a hub are joined with
the table of minima after that table is written: both sides of the join are
then plain shuffles, whose skewed partitions AQE can split (it cannot where
one side comes straight from an aggregate). Each round's edge list is written as a Parquet table in the shared
checkpoint folder, so lineage stays one round deep and a lost executor
recomputes one round.

Component label = smallest member id. ``cluster_id`` numbers components
0, 1, 2, ... in order of their smallest member (the order a sorted-node
scan discovers them).
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, materialize

MAX_ROUNDS = 200
_POS_BITS = 33  # monotonically_increasing_id: partition index << 33 | row index


def canonical_edges(edges: DataFrame, src: str = "uei_l", dst: str = "uei_r") -> DataFrame:
    """Undirected edge list as (a, b) with a > b, self-loops and repeats removed."""
    return (edges.select(F.greatest(src, dst).alias("a"), F.least(src, dst).alias("b"))
                 .where(F.col("a") != F.col("b"))
                 .distinct())


# Nodes that a task holds before it hands on the forest of the edges read so far.
FOREST_NODES = 500_000


def _forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parent: dict = {}

    def find(x):
        root = x
        while (up := parent.setdefault(root, root)) != root:
            root = up
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    def trees(schema) -> pa.RecordBatch:
        links = [(x, root) for x in list(parent) if (root := find(x)) != x]
        parent.clear()
        return pa.RecordBatch.from_arrays([pa.array([link[i] for link in links], schema.field(i).type) for i in (0, 1)], schema=schema)

    schema = None
    for batch in batches:
        schema = batch.schema
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = find(a), find(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
        if len(parent) > FOREST_NODES:
            yield trees(schema)
    if schema is not None:
        yield trees(schema)


def spanning_edges(edges: DataFrame, src: str = "uei_l", dst: str = "uei_r") -> DataFrame:
    """(a, b), a > b: edges of the same components as ``edges``, thinned by each
    task to a forest of the edges it reads, so that what is shuffled grows with
    the nodes, not with the edges of a dense cluster."""
    both = edges.select(F.greatest(src, dst).alias("a"), F.least(src, dst).alias("b")).where(F.col("a") != F.col("b"))
    return both.mapInArrow(_forests, both.schema)


def _neighbourhoods(e: DataFrame) -> DataFrame:
    """(u, m, smaller, larger): m = smallest of u and its neighbours, and how
    many edges lead to smaller and to larger ones."""
    both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        e.select(F.col("b").alias("u"), F.col("a").alias("v")))
    below = (F.col("v") < F.col("u")).cast("long")
    return both.groupBy("u").agg(F.min("v").alias("mv"), F.sum(below).alias("smaller"), F.sum(1 - below).alias("larger")).select(
        "u", F.least("u", "mv").alias("m"), "smaller", "larger")


def _large_star(e: DataFrame, around: DataFrame | None = None) -> DataFrame:
    # ``around``: the written _neighbourhoods of e.
    around = around if around is not None else materialize(_neighbourhoods(e), "cc-large-star")
    # Connect every strictly larger neighbour v of u to m(u): edges (v, m(u)), v > m.
    # One output edge per input edge, so no de-duplication shuffle here: the
    # small-star step's min aggregates ignore repeats and it ends with distinct.
    larger = e.select(F.col("b").alias("u"), F.col("a").alias("v"))
    return larger.join(around.select("u", "m"), "u").select(F.col("v").alias("a"), F.col("m").alias("b"))


def _small_star(e: DataFrame) -> DataFrame:
    # For u, its smaller neighbours are the b of edges (u, b); m = min of them.
    mins = materialize(e.groupBy("a").agg(F.min("b").alias("m")), "cc-small-star")
    moved = e.join(mins, "a").select(F.col("b").alias("x"), F.col("m").alias("y"))
    centre = mins.select(F.col("a").alias("x"), F.col("m").alias("y"))
    out = moved.unionByName(centre).where(F.col("x") != F.col("y"))
    return out.select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct()


def _settled(around: DataFrame) -> bool:
    """Whether the edges are a forest of stars centred on their minimum: no
    node has two smaller neighbours, or both a smaller and a larger one."""
    return around.where((F.col("smaller") > 1) | ((F.col("smaller") > 0) & (F.col("larger") > 0))).isEmpty()


def component_labels(edges: DataFrame, src: str = "uei_l", dst: str = "uei_r",
                     max_rounds: int = MAX_ROUNDS) -> DataFrame:
    """(node, label): label = smallest node of the node's component.
    Only nodes with at least one edge appear.

    The rounds run on ``long`` node ids (8-byte shuffle keys and hash
    aggregation instead of sorting strings in every round); nodes that are
    longs already stand for themselves. Otherwise ids are written once, so
    they are stable; the smallest original id of each component is found by
    one aggregation at the end."""
    ensure_checkpoint_dir(edges.sparkSession)
    canon = canonical_edges(edges, src, dst)
    if canon.schema["a"].dataType.simpleString() == canon.schema["b"].dataType.simpleString() == "bigint":
        return _star_forest(materialize(canon, "cc-edges"), max_rounds).select(
            F.col("nid").alias("node"), F.col("cid").alias("label"))
    # Components need no more than the forests of the tasks' edges.
    canon = materialize(canonical_edges(spanning_edges(edges, src, dst), "a", "b"), "cc-spanning")
    nodes = canon.select(F.col("a").alias("node")).union(canon.select(F.col("b").alias("node"))).distinct()
    ids = materialize(nodes.withColumn("nid", F.monotonically_increasing_id()), "cc-node-ids")
    e = (canon.join(ids.select(F.col("node").alias("a"), F.col("nid").alias("ia")), "a")
              .join(ids.select(F.col("node").alias("b"), F.col("nid").alias("ib")), "b")
              .select(F.greatest("ia", "ib").alias("a"), F.least("ia", "ib").alias("b")))
    stars = _star_forest(materialize(e, "cc-edges"), max_rounds)
    named = materialize(stars.join(ids, "nid").select("cid", "node"), "cc-named")
    smallest = materialize(named.groupBy("cid").agg(F.min("node").alias("label")), "cc-smallest")
    return named.join(smallest, "cid").select("node", "label")


def _star_forest(e: DataFrame, max_rounds: int) -> DataFrame:
    """(nid, cid): every node with the smallest node of its component."""
    for rounds in range(max_rounds + 1):
        around = materialize(_neighbourhoods(e), f"cc-around-{rounds}")
        if _settled(around):
            break
        if rounds == max_rounds:
            raise RuntimeError(f"connected components did not converge in {max_rounds} rounds")
        larger = materialize(_large_star(e, around), f"cc-larger-{rounds}")
        e = materialize(_small_star(larger), f"cc-edges-{rounds}")
    leaves = e.select(F.col("a").alias("nid"), F.col("b").alias("cid"))
    centres = e.select(F.col("b").alias("nid"), F.col("b").alias("cid")).distinct()
    return leaves.unionByName(centres)


def dense_ids(keys: DataFrame, key: str, id_col: str = "id") -> DataFrame:
    """Numbers the distinct values of ``key`` 0, 1, 2, ... in ascending order
    without a single-task global window: range-partitioned sort, then each
    partition's rows are offset by the row counts of the partitions before it
    (a table with one row per partition)."""
    spark = keys.sparkSession
    ensure_checkpoint_dir(spark)
    ordered = (keys.repartitionByRange(key).sortWithinPartitions(key)
                   .withColumn("_mid", F.monotonically_increasing_id()))
    # Written before use: the ids must not be recomputed with other partitions.
    ordered = materialize(ordered, "dense-ids")
    with_part = ordered.withColumn("_part", F.shiftright("_mid", _POS_BITS)).withColumn(
        "_pos", F.col("_mid").bitwiseAND(F.lit((1 << _POS_BITS) - 1)))
    counts = with_part.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_offset"))
    # One row per partition: a proven size bound, so broadcasting is safe.
    return (with_part.join(F.broadcast(offsets), "_part")
                     .withColumn(id_col, (F.col("_offset") + F.col("_pos")).cast("long"))
                     .drop("_mid", "_part", "_pos", "_offset"))


def connected_components(edges: DataFrame, src: str = "uei_l", dst: str = "uei_r",
                         id_col: str = "uei") -> DataFrame:
    """(cluster_id, <id_col>, cluster_size) for every node with an edge."""
    return numbered_components(component_labels(edges, src, dst), id_col)


def numbered_components(labels: DataFrame, id_col: str = "uei") -> DataFrame:
    """(cluster_id, <id_col>, cluster_size) of (node, label) rows."""
    sizes = labels.groupBy("label").agg(F.count(F.lit(1)).alias("cluster_size"))
    ids = dense_ids(sizes, "label", "cluster_id")
    # ids has one row per cluster; AQE picks broadcast when it is small and
    # splits the partition of a giant cluster otherwise.
    return (labels.join(ids, "label")
                  .select("cluster_id", F.col("node").alias(id_col), "cluster_size"))


def add_edges(labels: DataFrame, edges: DataFrame, src: str = "uei_l", dst: str = "uei_r") -> DataFrame:
    """(node, label) after ``edges`` are added to the graph that ``labels``
    describes; equal to labelling all edges anew.

    Rounds run on the graph of labels alone: an edge within a component is none
    there, and what stays has at most as many nodes as the new edges have ends,
    whatever the size of the stored components. A label is its component's
    smallest node, so the smallest of the labels that meet is the new one."""
    ensure_checkpoint_dir(edges.sparkSession)
    canon = materialize(canonical_edges(edges, src, dst), "cc-added")
    ends = canon.select(F.col("a").alias("node")).union(canon.select(F.col("b").alias("node"))).distinct()
    known = labels.select(F.col("node").alias("known"), "label")
    placed = materialize(ends.join(known, F.col("node") == F.col("known"), "left").select(
        "node", F.coalesce("label", "node").alias("label"), F.col("known").isNull().alias("new")), "cc-added-ends")
    between = (canon.join(placed.select(F.col("node").alias("a"), F.col("label").alias("la")), "a")
                    .join(placed.select(F.col("node").alias("b"), F.col("label").alias("lb")), "b"))
    met = component_labels(between, "la", "lb").select(F.col("node").alias("met"), F.col("label").alias("to"))
    grown = labels.select("node", "label").unionByName(placed.where("new").select("node", "label"))
    return grown.join(met, F.col("label") == F.col("met"), "left").select("node", F.coalesce("to", "label").alias("label"))


def remove_edges(labels: DataFrame, removed: DataFrame, left: DataFrame, src: str = "uei_l", dst: str = "uei_r") -> DataFrame:
    """(node, label) after the ``removed`` edges are gone and the edges
    ``left`` stay: the components of the removed edges are labelled anew from
    those of their edges that are left, the others keep their labels. Nodes
    without an edge go."""
    ensure_checkpoint_dir(left.sparkSession)
    gone = canonical_edges(removed, src, dst)
    ends = gone.select(F.col("a").alias("node")).union(gone.select(F.col("b").alias("node"))).distinct()
    touched = materialize(labels.join(ends, "node", "left_semi").select("label").distinct(), "cc-touched")
    nodes = labels.join(touched, "label", "left_semi").select(F.col("node").alias(src))
    again = component_labels(left.join(nodes, src, "left_semi"), src, dst)
    return labels.join(touched, "label", "left_anti").select("node", "label").unionByName(again.select("node", "label"))


def change_edges(labels: DataFrame, before: DataFrame, after: DataFrame, src: str = "uei_l", dst: str = "uei_r") -> DataFrame:
    """(node, label) of the edges ``after``, from the ``labels`` of the edges
    ``before``: only the edges in which the two differ are worked on."""
    old, new = canonical_edges(before, src, dst), canonical_edges(after, src, dst)
    removed = materialize(old.join(new, ["a", "b"], "left_anti"), "cc-removed-edges")
    added = materialize(new.join(old, ["a", "b"], "left_anti"), "cc-added-edges")
    if not removed.isEmpty():
        stay = old.join(removed, ["a", "b"], "left_anti")
        labels = materialize(remove_edges(labels, removed, stay, "a", "b"), "cc-after-removal")
    return labels if added.isEmpty() else add_edges(labels, added, "a", "b")


def graph_nodes(edges: DataFrame, src: str = "uei_l", dst: str = "uei_r") -> DataFrame:
    """Distinct nodes from both edge ends."""
    return edges.select(F.col(src).alias("node")).union(edges.select(F.col(dst).alias("node"))).distinct()


def entity_clusters(membership: DataFrame, latest: DataFrame, id_col: str = "uei") -> DataFrame:
    """Cluster membership with entity attributes (LEFT join: a member missing
    from the latest table keeps NULL attributes)."""
    attrs = latest.select(id_col, "legal_name", "name_norm", "phys_city", "phys_state", "zip5",
                          "entity_url", "cage_code", "primary_naics", "entity_structure",
                          "initial_reg_date")
    return (membership.join(attrs, id_col, "left")
                      .select("cluster_id", id_col, "legal_name", "name_norm", "phys_city",
                              "phys_state", "zip5", "entity_url", "cage_code", "primary_naics",
                              "entity_structure", "initial_reg_date", "cluster_size"))
