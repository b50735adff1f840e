"""Shared by the tests of the training-data operators."""

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


def union_find(n, pairs):
    """Smallest reachable index per index."""
    up = list(range(n))

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in pairs:
        x, y = find(a), find(b)
        if x != y:
            up[max(x, y)] = min(x, y)
    return [find(i) for i in range(n)]
