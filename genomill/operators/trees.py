"""Neighbour-joining trees with bootstrap support."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame

from . import dense


@dataclass
class Node:
    name: str = ""
    length: float = 0.0
    children: list[Node] = field(default_factory=list)

    def leaves(self) -> frozenset[str]:
        return frozenset([self.name]) if not self.children else frozenset().union(*(c.leaves() for c in self.children))


def neighbour_joining(d: np.ndarray, names: list[str]) -> Node:
    """The tree of a distance matrix; the first smallest pair is joined, the last two share
    their distance."""
    if len(names) == 1:
        return Node(names[0])
    nodes, d = [Node(n) for n in names], d.astype(float).copy()
    while len(nodes) > 2:
        n = len(nodes)
        r = d.sum(axis=1)
        q = (n - 2) * d - r[:, None] - r[None, :]
        q[np.tril_indices(n)] = np.inf
        i, j = np.unravel_index(np.argmin(q), q.shape)
        left = d[i, j] / 2 + (r[i] - r[j]) / (2 * (n - 2))
        nodes[i].length, nodes[j].length = left, d[i, j] - left
        new = (d[i] + d[j] - d[i, j]) / 2
        d[i] = d[:, i] = new
        d[i, i] = 0
        d = np.delete(np.delete(d, j, 0), j, 1)
        nodes[i] = Node(children=[nodes[i], nodes[j]])
        del nodes[j]
    nodes[0].length = nodes[1].length = d[0, 1] / 2
    return Node(children=nodes)


def splits(root: Node) -> set[frozenset[str]]:
    """The tree's splits of its leaves, each as the side without the first leaf by name."""
    every = root.leaves()
    first = min(every)
    out: set[frozenset[str]] = set()

    def go(node: Node) -> None:
        for c in node.children:
            side = c.leaves()
            side = every - side if first in side else side
            if 1 < len(side) < len(every) - 1:
                out.add(side)
            go(c)

    go(root)
    return out


def newick(root: Node, support: dict[frozenset[str], float] | None = None) -> str:
    every = root.leaves()
    first = min(every)

    def go(node: Node, top: bool = False) -> str:
        if not node.children:
            return f"{node.name}:{node.length:.6f}"
        inner = ",".join(go(c) for c in node.children)
        if top:
            return f"({inner});"
        side = node.leaves()
        side = every - side if first in side else side
        label = f"{support[side]:.0f}" if support and side in support else ""
        return f"({inner}){label}:{node.length:.6f}"

    return go(root, True)


def block_distances(called: DataFrame, sites: DataFrame, by: str = "chrom", kernel: Callable = dense.differences) -> tuple[list, np.ndarray, np.ndarray]:
    """(sample ids, differences of all pairs in each block, sites of each block), blocks in
    order of their names.  A missing call counts as homozygous reference; another ``kernel``
    (sums of distances of pairs, and the sites at [1, 0, 0]) gives another distance."""
    called = called.persist()
    try:
        ids = dense.sample_ids(called)
        got = dense.pair_sums(called, sites, ids, kernel, by)
    finally:
        called.unpersist()
    keys = sorted(got)
    n = np.array([got[k][1, 0, 0] for k in keys])
    return ids, np.array([got[k][0] for k in keys]).reshape(len(keys), len(ids), len(ids)) / 2, n


def supported(tree: Node, others: list[Node]) -> dict[frozenset[str], float]:
    """Percent of the other trees that have each split of the tree."""
    seen = dict.fromkeys(splits(tree), 0)
    for o in others:
        for s in splits(o) & seen.keys():
            seen[s] += 1
    return {s: 100 * c / max(len(others), 1) for s, c in seen.items()}


def bootstrap_tree(blocks: tuple[list, np.ndarray, np.ndarray], replicates: int = 100, seed: int = 0) -> tuple[Node, dict[frozenset[str], float]]:
    """(tree, percent support of its splits): replicates weigh block sums, so sites are read
    once however many there are."""
    ids, d, n = blocks
    labels, rng = [str(s) for s in ids], np.random.default_rng(seed)
    draws = [np.bincount(rng.integers(0, len(n), len(n)), minlength=len(n)) for _ in range(replicates)]
    tree = neighbour_joining(d.sum(axis=0) / max(n.sum(), 1), labels)
    return tree, supported(tree, [neighbour_joining(np.tensordot(w, d, 1) / max((w * n).sum(), 1), labels) for w in draws])


def site_bootstrap_tree(called: DataFrame, sites: DataFrame, replicates: int = 100, seed: int = 0) -> tuple[Node, dict[frozenset[str], float]]:
    """As ``bootstrap_tree`` with sites as the units that are drawn: a site counts Poisson(1)
    times in a replicate, so that all replicates are sums of one pass."""
    called = called.persist()
    try:
        ids = dense.sample_ids(called)
        got = dense.pair_sums(called, sites, ids, dense.resampled_differences(replicates, seed))[""]
    finally:
        called.unpersist()
    made = [neighbour_joining(x[0] / 2 / max(x[1, 0, 0], 1), [str(s) for s in ids]) for x in got]
    return made[0], supported(made[0], made[1:])
