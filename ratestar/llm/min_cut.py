"""Minimum cut of a small undirected graph with source and sink capacities at every node."""

from __future__ import annotations

from collections import deque


def source_side(scores: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """For each node whether it stays with the source in a cut of least capacity.

    A positive score is the cost of cutting a node from the source, a negative
    one that of cutting it from the sink; an edge costs its weight if its ends
    part. The maximum flow is found along shortest augmenting paths, level by
    level. Of several least cuts the one with the fewest nodes at the source is taken.
    """
    if all(s >= 0 for s in scores) or not any(s > 0 for s in scores):
        return [s > 0 or (s == 0 and all(x >= 0 for x in scores) and any(scores)) for s in scores]
    size = len(scores)
    heads: list[list[int]] = [[] for _ in range(size)]
    to, room = [], []
    for a, b, weight in edges:
        heads[a].append(len(to))
        to.append(b)
        room.append(weight)
        heads[b].append(len(to))
        to.append(a)
        room.append(weight)
    supply = [max(s, 0.0) for s in scores]
    demand = [max(-s, 0.0) for s in scores]
    tiny = 1e-9
    while True:
        level = [-1] * size
        queue = deque(i for i in range(size) if supply[i] > tiny)
        for i in queue:
            level[i] = 0
        reached = False
        while queue:
            i = queue.popleft()
            reached = reached or demand[i] > tiny
            for e in heads[i]:
                if room[e] > tiny and level[to[e]] < 0:
                    level[to[e]] = level[i] + 1
                    queue.append(to[e])
        if not reached:
            return [x >= 0 for x in level]
        turn = [0] * size
        for start in range(size):
            while supply[start] > tiny and level[start] == 0:
                path, i = [], start
                while demand[i] <= tiny:
                    while turn[i] < len(heads[i]):
                        e = heads[i][turn[i]]
                        if room[e] > tiny and level[to[e]] == level[i] + 1:
                            break
                        turn[i] += 1
                    else:
                        if not path:
                            break
                        i = to[path.pop() ^ 1]
                        turn[i] += 1
                        continue
                    path.append(e)
                    i = to[e]
                if demand[i] <= tiny:
                    break
                flow = min([supply[start], demand[i], *(room[e] for e in path)])
                supply[start] -= flow
                demand[i] -= flow
                for e in path:
                    room[e] -= flow
                    room[e ^ 1] += flow
