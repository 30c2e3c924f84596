"""The message graph of an export record: validation, and the thread that was on display.

A graph is a map of node id to VARIANT node {parent, children, message}. Its links are read in the JVM; what needs look-ups by name
(Spark's maps are searched from end to end) goes through one Arrow function over a batch of graphs, in time that grows with the nodes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAPPING = "map<string,variant>"
VERDICT = T.StructType([T.StructField("defect", T.StringType()), T.StructField("path", T.ArrayType(T.IntegerType())), T.StructField("fallback", T.BooleanType())])


def kind(v: Column) -> Column:
    """STRING, OBJECT, ARRAY, VOID, BOOLEAN or a number's type; null for a missing value."""
    return F.regexp_extract(F.schema_of_variant(v), r"^([A-Z]+)", 1)


def field(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "variant")


def text_field(v: Column, path: str) -> Column:
    """A field that is a JSON string, else null."""
    return F.when(kind(field(v, path)) == "STRING", F.try_variant_get(v, path, "string"))


def mapping_of(record: Column) -> Column:
    """The graph of a record as a map, null if it is no object."""
    return F.when(kind(field(record, "$.mapping")) == "OBJECT", F.try_variant_get(record, "$.mapping", MAPPING))


def _given(v: Column) -> Column:
    """Neither missing nor JSON null."""
    return v.isNotNull() & (kind(v) != "VOID")


def with_links(df: DataFrame, mapping: str = "mapping") -> DataFrame:
    """Adds entries (the graph's nodes in its order) and links (node, is_node, has_parent, parent, kids, kids_ok) of each graph."""
    entries = F.transform(
        "entries",
        lambda e: F.struct(
            e["key"].alias("node"),
            (kind(e["value"]) == "OBJECT").alias("is_node"),
            F.coalesce(_given(field(e["value"], "$.parent")), F.lit(False)).alias("has_parent"),
            text_field(e["value"], "$.parent").alias("parent"),
            F.coalesce(F.try_variant_get(e["value"], "$.children", "array<variant>"), F.array().cast("array<variant>")).alias("kids"),
            (field(e["value"], "$.children").isNull() | (kind(field(e["value"], "$.children")) == "ARRAY")).alias("kids_ok"),
        ),
    )
    typed = F.transform(
        F.col("links"),
        lambda x: F.struct(
            x["node"].alias("node"),
            F.coalesce(x["is_node"], F.lit(False)).alias("is_node"),
            x["has_parent"].alias("has_parent"),
            x["parent"].alias("parent"),
            F.transform(x["kids"], lambda k: F.variant_get(k, "$", "string")).alias("kids"),
            (x["kids_ok"] & F.forall(x["kids"], lambda k: F.coalesce(kind(k) == "STRING", F.lit(False)))).alias("kids_ok"),
        ),
    )
    return df.withColumn("entries", F.map_entries(F.col(mapping))).withColumn("links", entries).withColumn("links", typed)


def with_thread(df: DataFrame, current: str = "current_node") -> DataFrame:
    """Adds defect (the first rule that the graph breaks, or null), path (places in entries, root to the node on display), fallback_branch and abandoned.

    Without a valid current node the last child is followed from the root. Graphs with a defect have no path.
    """
    found = df.withColumn("_graph", graph_verdicts("links", current))
    return found.withColumns({"defect": F.col("_graph.defect"), "path": F.col("_graph.path"), "fallback_branch": F.col("_graph.fallback"), "abandoned": F.size("links") - F.size("_graph.path")}).drop("_graph")


@F.arrow_udf(VERDICT)
def graph_verdicts(links: pa.Array, current: pa.Array) -> pa.Array:
    return verdicts(links, current)


class _Found:
    """Numbers of named nodes: a node is found by its graph and its name."""

    def __init__(self, graph: np.ndarray, code: np.ndarray, names: int):
        self.names = names
        key = graph * names + code
        self.order = np.argsort(key, kind="stable")
        self.sorted = key[self.order]

    def __call__(self, graph: np.ndarray, code: np.ndarray) -> np.ndarray:
        """-1 where a graph has no node of the name; -1 stands for an unknown name."""
        if not len(self.sorted):
            return np.full(len(graph), -1)
        key = graph * self.names + code
        at = np.minimum(np.searchsorted(self.sorted, key), len(self.sorted) - 1)
        return np.where((self.sorted[at] == key) & (code >= 0), self.order[at], -1)


def verdicts(links: pa.Array, current: pa.Array) -> pa.Array:
    """defect, path and fallback of each graph of a batch. All nodes of the batch lie in flat arrays.

    Roots, leaves and depths are found by pointer jumping: each round doubles the links that a node looks over, so a graph
    takes log-many rounds whatever its shape, and a path is read off the kept rounds, all its nodes at once.
    """
    n = len(links)
    sizes = pc.fill_null(pc.list_value_length(links), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    nodes = links.flatten()
    name, parent, kids = (pc.struct_field(nodes, f) for f in ("node", "parent", "kids"))
    is_node, has_parent, kids_ok = (pc.fill_null(pc.struct_field(nodes, f), False).to_numpy(zero_copy_only=False) for f in ("is_node", "has_parent", "kids_ok"))
    kid_sizes = pc.fill_null(pc.list_value_length(kids), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    kid_name = kids.flatten()
    pool = pc.unique(pa.concat_arrays([name, kid_name]))

    def code(names: pa.Array) -> np.ndarray:
        return pc.fill_null(pc.index_in(names, value_set=pool), -1).to_numpy(zero_copy_only=False).astype(np.int64)

    graph, own = np.repeat(np.arange(n), sizes), np.arange(len(name))
    owner = np.repeat(own, kid_sizes)
    codes, kid_code = code(name), code(kid_name)
    find = _Found(graph, codes, len(pool) + 1)
    up, kid = find(graph, code(parent)), find(graph[owner], kid_code)
    listed = np.sort(owner * (len(pool) + 1) + kid_code)

    def some(graphs: np.ndarray) -> np.ndarray:
        return np.bincount(graphs, minlength=n) > 0

    twice = np.flatnonzero(listed[1:] == listed[:-1])
    linked = has_parent & (up >= 0)
    unlisted = np.flatnonzero(linked)
    unlisted = unlisted[~np.isin(up[unlisted] * (len(pool) + 1) + codes[unlisted], listed)]
    known = kid >= 0
    other = np.flatnonzero(known)
    other = other[~has_parent[kid[other]] | (up[kid[other]] != owner[other])]
    roots = np.bincount(graph[~has_parent], minlength=n)
    root = np.zeros(n, np.int64)
    root[graph[~has_parent]] = own[~has_parent]
    up = np.where(linked, up, own)
    jumps, depth = [up], (up != own).astype(np.int64)
    for _ in range(int(sizes.max(initial=1)).bit_length()):
        last = jumps[-1]
        depth += depth[last]
        jumps.append(last[last])
    rules = (
        ("no_mapping", sizes == 0),
        ("not_a_node", some(graph[~is_node])),
        ("children_not_a_list", some(graph[~kids_ok])),
        ("duplicate_child", some(graph[listed[twice] // (len(pool) + 1)])),
        ("dangling_parent", some(graph[has_parent & ~linked])),
        ("parent_does_not_list_child", some(graph[unlisted])),
        ("dangling_child", some(graph[owner[~known]])),
        ("child_names_other_parent", some(graph[owner[other]])),
        ("not_one_root", roots != 1),
        ("unreachable_node", some(graph[jumps[-1] != root[graph]])),
    )
    defect = np.select([broken for _, broken in rules], np.arange(len(rules)), -1)
    sound = np.flatnonzero(defect < 0)

    shown = find(np.arange(n), code(current.cast(pa.string())))
    fallback = shown < 0
    leaf = own.copy()
    ends, some_kids = np.cumsum(kid_sizes) - 1, kid_sizes > 0
    leaf[some_kids] = np.maximum(kid[ends[some_kids]], 0)
    for _ in range(len(jumps) if fallback[sound].any() else 0):
        leaf = leaf[leaf]
    shown = np.where(fallback[sound], leaf[root[sound]], shown[sound]) if len(own) else np.zeros(0, np.int64)
    length = np.zeros(n, np.int64)
    length[sound] = depth[shown] + 1
    stop = np.cumsum(length[sound])
    # The place in the path says how many links lie between the node and the one on display.
    above = np.repeat(stop, length[sound]) - 1 - np.arange(stop[-1] if len(stop) else 0)
    at = np.repeat(shown, length[sound])
    for bit, jump in enumerate(jumps):
        at = np.where((above >> bit) & 1, jump[at], at)
    place = at - (np.cumsum(sizes) - sizes)[graph[at]]
    offsets = pa.array(np.concatenate([[0], np.cumsum(length)]), pa.int32())
    paths = pa.ListArray.from_arrays(offsets, pa.array(place, pa.int32()), mask=pa.array(defect >= 0))
    names = [r for r, _ in rules]
    return pa.StructArray.from_arrays([pa.array([names[d] if d >= 0 else None for d in defect.tolist()], pa.string()), paths, pa.array(fallback)], ["defect", "path", "fallback"])


def graph_nodes(df: DataFrame, key: str = "source_id") -> DataFrame:
    """One row per node: key, node, parent, children; for work on links as joins."""
    return df.select(key, F.explode("links").alias("x")).select(key, F.col("x.node").alias("node"), F.col("x.parent").alias("parent"), F.col("x.kids").alias("children"))


def link_defects(nodes: DataFrame, key: str = "source_id") -> DataFrame:
    """Links that only one side knows, as joins of the nodes with themselves: key, node, other, defect."""
    up = nodes.where(F.col("parent").isNotNull()).select(key, F.col("node"), F.col("parent").alias("other"))
    down = nodes.select(key, F.col("node").alias("other"), F.explode("children").alias("node"))
    known = nodes.select(key, F.col("node").alias("other"))
    named = nodes.select(key, "node")
    return (
        up.join(known, [key, "other"], "left_anti").withColumn("defect", F.lit("dangling_parent"))
        .unionByName(up.join(known, [key, "other"]).join(down, [key, "node", "other"], "left_anti").withColumn("defect", F.lit("parent_does_not_list_child")))
        .unionByName(down.join(named, [key, "node"], "left_anti").withColumn("defect", F.lit("dangling_child")))
        .unionByName(down.join(named, [key, "node"]).join(up, [key, "node", "other"], "left_anti").withColumn("defect", F.lit("child_names_other_parent")))
        .select(key, "node", "other", "defect")
    )
