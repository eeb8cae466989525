"""Grouped k-means against plain loops."""

import math
import random

from secflow.operators import lloyd

NAMES = ["u", "v"]


def _plain(points, k, iterations=100):
    """Farthest-first centres, then means until none moves; ties go to the first centre."""
    square = lambda x, c: sum((a - b) * (a - b) for a, b in zip(x, c, strict=True))
    centres = [max(points)]
    while len(centres) < k:
        far = max((min(square(x, c) for c in centres), x) for x in points)
        if far[0] == 0:
            break
        centres.append(far[1])
    for _ in range(iterations):
        nearest = [min(range(len(centres)), key=lambda i: (square(x, centres[i]), i)) for x in points]
        moved = []
        for i, c in enumerate(centres):
            mine = [x for x, n in zip(points, nearest, strict=True) if n == i]
            moved.append([round(sum(col) / len(mine), 9) for col in zip(*mine, strict=True)] if mine else c)
        if moved == centres:
            break
        centres = moved
    nearest = [min(range(len(centres)), key=lambda i: (square(x, centres[i]), i)) for x in points]
    cost = sum(square(x, centres[n]) for x, n in zip(points, nearest, strict=True))
    total = 0.0
    for p, (x, n) in enumerate(zip(points, nearest, strict=True)):
        by = {}
        for q, (y, m) in enumerate(zip(points, nearest, strict=True)):
            if p != q:
                by.setdefault(m, []).append(square(x, y))
        a, others = by.pop(n, None), [sum(d) / len(d) for d in by.values()]
        if a and others:
            a, b = sum(a) / len(a), min(others)
            total += (b - a) / max(a, b) if max(a, b) else 0.0
    return centres, nearest, cost, total / len(points)


def test_groups_equal_plain_loops(spark):
    rng = random.Random(3)
    rows = [(g, f"{g}-{i}", rng.randrange(40) / 4 + 20 * rng.randrange(3), rng.randrange(40) / 4)
            for g, n in ((1, 60), (2, 25), (3, 4), (4, 1)) for i in range(n)]
    rows += [(5, f"5-{i}", 7.0, 7.0) for i in range(6)]  # all alike
    df = spark.createDataFrame(rows, "cluster int, ip string, u double, v double").repartition(5)
    points = lloyd.group_points(df, NAMES, "cluster")
    held = {r.ip: (r.parent, list(r.x)) for r in points.collect()}
    counts = [2, 3, 5]
    state = lloyd.fit_groups(points, 2, counts, 100)
    fitted = {(r.parent, r.k): [list(c) for c in r.centres] for r in state.collect()}
    scores = {(r.parent, r.k): (r.silhouette, r.cost) for r in lloyd.group_scores(points, state, 2).collect()}
    best = {r.ip: r for r in lloyd.label(points, lloyd.best_groups(points, 2, counts, 100), 2).collect()}
    assert len(best) == len(rows) and set(fitted) == {(g, k) for g in range(1, 6) for k in counts}
    for g in range(1, 6):
        ips = sorted(ip for ip, (p, _) in held.items() if p == g)
        xs = [held[ip][1] for ip in ips]
        assert all(0 <= v <= 1 for x in xs for v in x)
        plain = {k: _plain(xs, k) for k in counts}
        for k in counts:
            assert fitted[g, k] == plain[k][0]
            assert math.isclose(scores[g, k][0], plain[k][3], abs_tol=1e-9)
            assert math.isclose(scores[g, k][1], plain[k][2], abs_tol=1e-9)
        chosen = max(counts, key=lambda k: (round(plain[k][3], 9), -k))
        assert [best[ip].cluster for ip in ips] == plain[chosen][1] and {best[ip].k for ip in ips} == {chosen}


def test_missing_features_and_empty_tables(spark):
    schema = "ip string, u long, v long"
    df = spark.createDataFrame([("a", None, 1), ("b", 5, 1), ("c", 9, 1), ("c", 9, 1)], schema)
    points = lloyd.group_points(df, NAMES)
    assert sorted(tuple(r.x) for r in points.collect()) == [(0.0, 0.0), (0.0, 0.0), (1.0, 0.0), (1.0, 0.0)]
    rows = lloyd.label(points, lloyd.best_groups(points, 2, (2, 3), 10), 2).collect()
    assert len(rows) == 4 and {r.distance for r in rows} == {0.0} and {r.k for r in rows} == {2}
    none = lloyd.group_points(df.where("false"), NAMES)
    assert lloyd.label(none, lloyd.best_groups(none, 2, (2, 3), 10), 2).count() == 0
