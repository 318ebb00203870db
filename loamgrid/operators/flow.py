"""Minimum-cost flow on small networks.

A network is solved whole on one worker (or the driver): callers aggregate first, so that its size follows the number of
groups, pools or sources and never the number of rows.
"""

from __future__ import annotations

from heapq import heappop, heappush


class Network:
    """Directed edges with integer capacity and cost; nodes are any hashable values."""

    def __init__(self) -> None:
        self.index: dict[object, int] = {}
        self.out: list[list[int]] = []
        self.head: list[int] = []
        self.left: list[int] = []
        self.cost: list[int] = []

    def node(self, name: object) -> int:
        if name not in self.index:
            self.index[name] = len(self.out)
            self.out.append([])
        return self.index[name]

    def edge(self, a: object, b: object, capacity: int, cost: int = 0) -> int:
        """Adds an edge and returns its number, for `flow`."""
        number = len(self.head)
        for x, y, room, price in ((a, b, int(capacity), cost), (b, a, 0, -cost)):
            self.out[self.node(x)].append(len(self.head))
            self.head.append(self.node(y))
            self.left.append(room)
            self.cost.append(price)
        return number

    def flow(self, number: int) -> int:
        """What runs through an edge."""
        return self.left[number ^ 1]

    def solve(self, source: object, sink: object, most: int | None = None) -> tuple[int, int]:
        """Greatest flow, up to `most`, of least cost: (flow, cost).

        Shortest paths under node potentials, so that every search sees costs of at least 0; costs given must not be negative.
        """
        start, stop, total, paid = self.node(source), self.node(sink), 0, 0
        rise = [0] * len(self.out)
        while most is None or total < most:
            far: list[float] = [float("inf")] * len(self.out)
            via = [-1] * len(self.out)
            far[start] = 0
            queue: list[tuple[float, int]] = [(0, start)]
            while queue:
                d, x = heappop(queue)
                if d > far[x]:
                    continue
                for e in self.out[x]:
                    y = self.head[e]
                    if self.left[e] > 0 and d + self.cost[e] + rise[x] - rise[y] < far[y]:
                        far[y], via[y] = d + self.cost[e] + rise[x] - rise[y], e
                        heappush(queue, (far[y], y))
            if via[stop] < 0:
                break
            rise = [r + int(d) if d < float("inf") else r for r, d in zip(rise, far, strict=True)]
            path, x = [], stop
            while x != start:
                path.append(via[x])
                x = self.head[via[x] ^ 1]
            push = min(self.left[e] for e in path)
            push = push if most is None else min(push, most - total)
            for e in path:
                self.left[e] -= push
                self.left[e ^ 1] += push
                paid += push * self.cost[e]
            total += push
        return total, paid
