import random

from tidemark.llm.components import components


def test_chains_stars_loops_and_repeats(spark):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 560)]
    links += [(7, 7), (160, 100), (501, 500)] + [(rng.randrange(900, 960), rng.randrange(900, 960)) for _ in range(40)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        high, low = max(find(a), find(b)), min(find(a), find(b))
        root[high] = low
    wanted = {x: find(x) for pair in links if pair[0] != pair[1] for x in pair}
    got = components(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    assert len(got) == len(wanted)
    assert {r.node: r.root for r in got} == wanted


def test_no_links(spark):
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []
