from chargewise.llm.components import connected_components


def test_components_against_union_find(spark, rng):
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 360)] + [(7, 7)]
    edges += [(500, x) for x in range(400, 460)]
    up = {}

    def find(x):
        while up.get(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        p, q = find(a), find(b)
        up[max(p, q)] = min(p, q)
    nodes = {x for e in edges for x in e}
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in nodes if find(x) != x}


def test_no_edges(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []
