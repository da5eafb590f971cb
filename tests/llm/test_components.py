import random

from brute import component_of

from calibra.llm.components import components


def check(spark, links):
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    want = component_of({n for l in links for n in l}, links)
    assert found == {n: c for n, c in want.items() if n != c}


def test_path_star_and_random(spark):
    rng = random.Random(3)
    path = list(range(40))
    rng.shuffle(path)
    check(spark, list(zip(path, path[1:])))
    check(spark, [(0, i) for i in range(1, 300)] + [(1000, i) for i in range(250, 320)])
    check(spark, [(rng.randrange(150), rng.randrange(150)) for _ in range(110)])


def test_loops_repeats_nulls_and_nothing(spark):
    df = spark.createDataFrame([(1, 1), (3, 2), (2, 3), (3, None), (None, None)], "a bigint, b bigint")
    assert [tuple(r) for r in components(df).collect()] == [(3, 2)]
    assert components(df.limit(0)).count() == 0
