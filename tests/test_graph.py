"""Graph rules and threads against a plain walk, on random and on very deep graphs."""

import random
import time

import pyarrow as pa
import pytest

from chatloom.operators.graph import verdicts

LINK = pa.struct([("node", pa.string()), ("is_node", pa.bool_()), ("has_parent", pa.bool_()), ("parent", pa.string()), ("kids", pa.list_(pa.string())), ("kids_ok", pa.bool_())])


def links(graph):
    return [{"node": k, "is_node": v is not None, "has_parent": v is not None and v[0] is not None, "parent": v[0] if v else None, "kids": v[1] if v else [], "kids_ok": True} for k, v in graph.items()]


def ask(*cases):
    found = verdicts(pa.array([None if g is None else links(g) for g, _ in cases], pa.list_(LINK)), pa.array([c for _, c in cases], pa.string()))
    return [(r["defect"], r["path"] if r["path"] is None else [list(g)[i] for i in r["path"]], r["fallback"]) for r, (g, _) in zip(found.to_pylist(), cases, strict=True)]


def walk(graph, current):
    """The rules one after another, by dictionaries."""
    if not graph:
        return "no_mapping", None
    if any(v is None for v in graph.values()):
        return "not_a_node", None
    rules = {
        "duplicate_child": lambda k, p, c: len(set(c)) != len(c),
        "dangling_parent": lambda k, p, c: p is not None and p not in graph,
        "parent_does_not_list_child": lambda k, p, c: p is not None and k not in graph[p][1],
        "dangling_child": lambda k, p, c: any(x not in graph for x in c),
        "child_names_other_parent": lambda k, p, c: any(graph[x][0] != k for x in c),
    }
    for name, rule in rules.items():
        if any(rule(k, *v) for k, v in graph.items()):
            return name, None
    roots = [k for k, v in graph.items() if v[0] is None]
    if len(roots) != 1:
        return "not_one_root", None
    reached, queue = set(), list(roots)
    while queue:
        reached.add(x := queue.pop())
        queue += graph[x][1]
    if len(reached) != len(graph):
        return "unreachable_node", None
    at = current if current in graph else roots[0]
    while current not in graph and graph[at][1]:
        at = graph[at][1][-1]
    path = [at]
    while graph[path[-1]][0] is not None:
        path.append(graph[path[-1]][0])
    return None, path[::-1]


def tree(rng, n):
    graph = {"r": [None, []]}
    for i in range(n):
        parent = rng.choice(list(graph))
        graph[parent][1].append(f"n{i}")
        graph[f"n{i}"] = [parent, []]
    items = list(graph.items())
    rng.shuffle(items)
    return dict(items)


def damaged(rng, graph):
    kind, (a, b) = rng.randrange(8), (rng.choice(list(graph)), rng.choice(list(graph)))
    if kind == 0:
        graph[a][1].append("lost")
    elif kind == 1:
        graph[a][0] = "gone"
    elif kind == 2:
        graph[a][1].append(b)
    elif kind == 3:
        graph[a][1].clear()
    elif kind == 4:
        graph["second"] = [None, []]
    elif kind == 5:
        graph["x"], graph["y"] = ["y", ["y"]], ["x", ["x"]]
    elif kind == 6:
        graph[a] = None
    return graph


def test_random_graphs_equal_a_walk():
    rng = random.Random(4)
    cases = [(None, "a"), ({}, None)]
    for i in range(600):
        g = tree(rng, rng.randrange(12))
        current = rng.choice([None, "nowhere", *g])
        cases.append((damaged(rng, g) if i % 2 else g, current))
    seen = set()
    for (g, c), (defect, path, fallback) in zip(cases, ask(*cases), strict=True):
        assert (defect, path) == walk(g or {}, c), (g, c)
        seen.add(defect)
        if defect is None:
            assert fallback == (c not in g)
    assert len(seen) == 10


def test_slices_of_a_batch():
    rng = random.Random(9)
    cases = [(tree(rng, 5), None) for _ in range(6)]
    whole = pa.array([links(g) for g, _ in cases], pa.list_(LINK))
    current = pa.array(["n1"] * 6)
    assert verdicts(whole, current).slice(2, 3).to_pylist() == verdicts(whole.slice(2, 3), current.slice(2, 3)).to_pylist()
    assert verdicts(whole.slice(0, 0), current.slice(0, 0)).to_pylist() == []


@pytest.mark.parametrize("current", ["leaf", None])
def test_time_grows_with_the_nodes(current):
    def chain(n):
        graph = {f"n{i}": [f"n{i - 1}" if i else None, [f"n{i + 1}"]] for i in range(n)}
        graph[f"n{n}"] = [f"n{n - 1}", []]
        return pa.array([links(graph)], pa.list_(LINK)), pa.array([f"n{n}" if current else None], pa.string())

    def took(case):
        times = []
        for _ in range(3):
            began = time.perf_counter()
            found = verdicts(*case)
            times.append(time.perf_counter() - began)
        assert len(found.to_pylist()[0]["path"]) == len(case[0].to_pylist()[0])
        return min(times)

    small, large = chain(8000), chain(16000)
    assert took(large) < 3.5 * took(small) + 0.02
    assert took(chain(200_000)) < 5
