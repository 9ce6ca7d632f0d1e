"""Hand graphs and brute-force references (pure Python) for operator tests."""

from __future__ import annotations

from collections import defaultdict, deque
from itertools import combinations


def frames(spark, vertices, edges):
    v = spark.createDataFrame([(x,) for x in vertices], "id string")
    e = spark.createDataFrame(list(edges), "src string, dst string")
    return v, e


def cc_brute(vertices, edges):
    parent = {v: v for v in vertices}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        ra, rb = find(a), find(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
    groups = defaultdict(list)
    for v in vertices:
        groups[find(v)].append(v)
    return {v: min(g) for g in groups.values() for v in g}


def reach(vertices, edges):
    out = defaultdict(set)
    for a, b in edges:
        out[a].add(b)
    r = {}
    for v in vertices:
        seen, q = {v}, deque([v])
        while q:
            x = q.popleft()
            for y in out[x]:
                if y not in seen:
                    seen.add(y)
                    q.append(y)
        r[v] = seen
    return r


def scc_brute(vertices, edges):
    r = reach(vertices, edges)
    return {v: min(u for u in vertices if u in r[v] and v in r[u]) for v in vertices}


def triangles_brute(vertices, edges):
    und = {frozenset((a, b)) for a, b in edges if a != b}
    count = {v: 0 for v in vertices}
    for x, y, z in combinations(sorted(vertices), 3):
        if {frozenset((x, y)), frozenset((y, z)), frozenset((x, z))} <= und:
            for v in (x, y, z):
                count[v] += 1
    return count


def bfs_brute(vertices, edges, sources, undirected=False):
    adj = defaultdict(set)
    for a, b in edges:
        adj[a].add(b)
        if undirected:
            adj[b].add(a)
    dist = {s: 0 for s in sources}
    q = deque(sources)
    while q:
        x = q.popleft()
        for y in adj[x]:
            if y not in dist:
                dist[y] = dist[x] + 1
                q.append(y)
    return dist
