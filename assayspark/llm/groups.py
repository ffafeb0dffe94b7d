"""Linked groups inside one task, for operators that compare blocks of rows."""

from __future__ import annotations

import numpy as np


def linked_lowest(nodes: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For each row the smallest node among the rows reachable by the links between places left and right.

    Rows with equal nodes are one. The result spans the same groups as the links do.
    """
    _, label = np.unique(nodes, return_inverse=True)
    place_of = np.zeros(label.max() + 1 if len(label) else 0, dtype=np.int64)
    place_of[label] = np.arange(len(label))
    group = np.arange(len(place_of))
    a, b = label[left], label[right]
    while len(a):
        low = np.minimum(group[a], group[b])
        np.minimum.at(group, group[a], low)
        np.minimum.at(group, group[b], low)
        while (group[group] != group).any():
            group = group[group]
        apart = group[a] != group[b]
        if not apart.any():
            break
        a, b = a[apart], b[apart]
    return nodes[place_of[group[label]]]
