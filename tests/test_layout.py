import random

from doclattice.operators import layout


def test_components_against_a_plain_search(spark):
    rng = random.Random(9)
    rows = [(p, b, x := rng.uniform(0, 100), y := rng.uniform(0, 100), x + rng.uniform(1, 15), y + rng.uniform(1, 15)) for p in range(5) for b in range(40)]
    df = spark.createDataFrame(rows, "page int, box long, x0 double, y0 double, x1 double, y1 double")
    got = {(r.page, r.box): r.component for r in layout.touching_components(df, ["page"]).collect()}
    for p in range(5):
        own = {r[1]: r[2:] for r in rows if r[0] == p}
        touch = lambda a, b: a[0] <= b[2] + 1 and b[0] <= a[2] + 1 and a[1] <= b[3] + 1 and b[1] <= a[3] + 1
        for start in own:
            seen, todo = {start}, [start]
            while todo:
                i = todo.pop()
                new = {j for j in own if j not in seen and touch(own[i], own[j])}
                seen |= new
                todo += new
            assert got[p, start] == min(seen)
