import numpy as np

from riskspark.llm.embedding_dup import near_vectors


def brute(rows):
    ok = []
    for k, (i, x, label) in enumerate(rows):
        if x is not None and label is not None and len(x) and all(y is not None and np.isfinite(y) for y in x) and any(x):
            ok.append(k)
    n = [0] * len(rows)
    comp = {r[0]: r[0] for r in rows}

    def find(a):
        while comp[a] != a:
            a = comp[a]
        return a
    unit = {k: np.array(rows[k][1], np.float32).astype(float) for k in ok}
    unit = {k: v / np.linalg.norm(v) for k, v in unit.items()}
    for p in range(len(ok)):
        for q in range(p):
            a, b = ok[p], ok[q]
            if rows[a][2] == rows[b][2] and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= .98:
                n[a] += 1
                n[b] += 1
                x, y = find(rows[a][0]), find(rows[b][0])
                comp[max(x, y)] = min(x, y)
    return sorted((r[0], n[k], find(r[0]), find(r[0]) == r[0]) for k, r in enumerate(rows))


def test_matches_brute_force(spark):
    rng = np.random.RandomState(3)
    rows = []

    def put(x, label):
        rows.append((len(rows), None if x is None else [None if y is None else float(y) for y in x], label))
    for _ in range(500):
        put(rng.randn(16), int(rng.randint(3)))
    for size, noise in ((2, .02), (2, .1), (5, .1), (30, .12), (90, .05), (60, .16)):
        c = rng.randn(16)
        c /= np.linalg.norm(c)
        for _ in range(size):
            put(c + noise * rng.randn(16) / 4, 1)
    same = rng.randn(16)
    for _ in range(40):
        put(same, 2)
    put(same * 3, 2)
    put(same, None)
    put(None, 2)
    put([], 2)
    put([0.0] * 16, 2)
    put([float("nan")] + [1.0] * 15, 2)
    put([None] + [1.0] * 15, 2)
    put([1.0] * 8, 2)
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, label int, vec string")
    got = sorted(map(tuple, near_vectors(df).collect()))
    want = brute(rows)
    assert [g[0] for g in got] == [w[0] for w in want]
    missed = sum(w[1] - g[1] for g, w in zip(got, want))
    assert all(g[1] <= w[1] for g, w in zip(got, want)) and missed <= 0.01 * sum(w[1] for w in want)
    assert sum(g[2:] != w[2:] for g, w in zip(got, want)) <= 4


def test_edges(spark):
    df = spark.createDataFrame([(None, [1.0, 0.0], 1), (None, [1.0, 0.0], 1), (7, [1.0, 0.0], 1), (7, [1.0, 0.0], 1), (None, [0.0, 1.0], 1)],
                               "vec_id long, embedding array<float>, label int")
    got = sorted(map(tuple, near_vectors(df).collect()), key=str)
    assert got == sorted([(None, 3, 7, False), (None, 3, 7, False), (7, 3, 7, True), (7, 3, 7, True), (None, 0, None, True)], key=str)
    assert near_vectors(df.limit(0)).collect() == []


def test_links_between_tight_groups(spark):
    """Lists full of their own group hold no link to the group beside it; a lone vector and a chain of groups too."""
    rng = np.random.RandomState(8)
    axes = np.linalg.qr(rng.randn(64, 64))[0]
    rows = []

    def put(centre, size, noise):
        for _ in range(size):
            x = centre + noise * rng.randn(64) / 8
            rows.append((len(rows), [float(y) for y in x], 1))
    for _ in range(300):
        put(rng.randn(64), 1, 0)
    for turn in (0, .17, .34):  # next groups at cosine 0.985, the first and the last at 0.943
        put(np.cos(turn) * axes[0] + np.sin(turn) * axes[1], 60, .02)
    put(np.cos(.17) * axes[0] + np.sin(.17) * axes[2], 1, 0)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = sorted(map(tuple, near_vectors(df).collect()))
    want = brute(rows)
    assert got == want and max(w[1] for w in want) >= 179


def test_the_audit_grows_where_links_are_sparse(spark, monkeypatch):
    """Few linked vectors: the audit goes on until it has links to measure, and the recall of the result is measured too."""
    from riskspark.llm import embedding_dup as E

    rng = np.random.RandomState(4)
    rows = []
    for _ in range(700):
        rows.append((len(rows), [float(y) for y in rng.randn(24)], 1))
    for _ in range(30):  # isolated pairs
        x = rng.randn(24)
        rows += [(len(rows) + k, [float(y) for y in x + .02 * rng.randn(24)], 1) for k in range(2)]
    seen = []
    one = E.audit

    def watched(nodes, n):
        ids, truth = one(nodes, n)
        seen.append((len(ids), sum(r["n"] for r in truth)))
        return ids, truth
    monkeypatch.setattr(E, "audit", watched)
    monkeypatch.setattr(E, "AUDIT_LINKS", 40)
    got = sorted(map(tuple, near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()))
    want = brute(rows)
    assert seen[0][0] == 760 and seen[0][1] == 60
    found, true = sum(g[1] for g in got), sum(w[1] for w in want)
    print(f"recall of sparse links: {found / true:.3f}")
    assert true == 60 and found >= .9 * true
