"""Minimum-cost flow for small integer networks (successive shortest paths)."""

from __future__ import annotations

import heapq


class Flow:
    """Arcs with integer capacities and integer costs; ``send`` routes the cheapest flow."""

    def __init__(self) -> None:
        self.heads: list[int] = []
        self.room: list[int] = []
        self.cost: list[int] = []
        self.out: dict[int, list[int]] = {}
        self.ids: dict[object, int] = {}

    def node(self, name: object) -> int:
        k = self.ids.setdefault(name, len(self.ids))
        self.out.setdefault(k, [])
        return k

    def arc(self, a: object, b: object, capacity: int, cost: int) -> int:
        """Add an arc; costs must not be negative. Returns its number, for ``used``."""
        for tail, head, room, price in ((a, b, capacity, cost), (b, a, 0, -cost)):
            self.out[self.node(tail)].append(len(self.heads))
            self.heads.append(self.node(head))
            self.room.append(room)
            self.cost.append(price)
        return len(self.heads) - 2

    def used(self, arc: int) -> int:
        return self.room[arc + 1]

    def send(self, source: object, sink: object, amount: int) -> int:
        """Route up to ``amount`` units from source to sink at the least cost; returns what was routed."""
        s, t = self.node(source), self.node(sink)
        potential = dict.fromkeys(self.out, 0)
        routed = 0
        while routed < amount:
            far, via = {s: 0}, {}
            heap = [(0, s)]
            done = set()
            while heap:
                d, v = heapq.heappop(heap)
                if v in done:
                    continue
                done.add(v)
                for k in self.out[v]:
                    w = self.heads[k]
                    if self.room[k] > 0 and w not in done:
                        nd = d + self.cost[k] + potential[v] - potential[w]
                        if w not in far or nd < far[w]:
                            far[w], via[w] = nd, k
                            heapq.heappush(heap, (nd, w))
            if t not in via:
                break
            most = max(far.values())
            for v in potential:
                potential[v] += far.get(v, most)
            path, v = [], t
            while v != s:
                path.append(via[v])
                v = self.heads[via[v] ^ 1]
            push = min([amount - routed, *(self.room[k] for k in path)])
            for k in path:
                self.room[k] -= push
                self.room[k ^ 1] += push
            routed += push
        return routed
