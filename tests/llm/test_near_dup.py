import random

from riskspark.llm.near_dup import near_duplicates


def brute(rows):
    def sh(t):
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in (t or "")).replace("\t", " ").replace("\n", " ").split(" ")
        w = [x for x in w if x]
        return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    s = {d: sh(t) for d, t in rows}
    comp = {d: d for d in s}

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x
    ids = list(s)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            k = len(s[a] & s[b])
            if k and 100 * k >= 75 * (len(s[a]) + len(s[b]) - k):
                x, y = find(a), find(b)
                comp[max(x, y)] = min(x, y)
    return sorted((d, len(s[d]), find(d), find(d) == d) for d in s)


def test_matches_brute_force(spark):
    rng = random.Random(3)
    vocab = [f"w{i}" for i in range(400)]
    rows, k = [], 0
    for _ in range(25):
        base = [rng.choice(vocab) for _ in range(rng.choice([3, 8, 60, 150]))]
        for _ in range(rng.randint(1, 9)):
            w = list(base)
            for _ in range(rng.randint(0, 5)):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            rows.append((k, " ".join(w) if rng.random() < .8 else "\n".join(w).upper()))
            k += 1
    rows += [(k, None), (k + 1, ""), (k + 2, " \t\n"), (k + 3, "one"), (k + 4, "ONE"), (k + 5, "x " * 30000)]
    rng.shuffle(rows)
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(tuple(r) for r in got.collect()) == brute(rows)


def test_edge_cases(spark):
    df = spark.createDataFrame([(5, "a b c d e f", 1, "x"), (5, "a b c d e f", 1, "x"), (2, "a b c d e f", 2, "y"),
                                (None, "a b c d e f", 3, "z"), (None, None, 3, "z")],
                               "doc_id long, text string, n long, component string")
    got = sorted(map(tuple, near_duplicates(df).collect()), key=str)
    assert got == sorted([(5, 2, 2, False), (5, 2, 2, False), (2, 2, 2, True), (None, 2, 2, False), (None, 0, None, True)], key=str)
    assert near_duplicates(df.limit(0)).collect() == []


def test_large_group_of_far_copies(spark):
    """Copies around one text that are often below the threshold to each other and to the centre."""
    rng = random.Random(8)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for k in range(260):
        w = list(base)
        for _ in range(rng.randint(1, 6)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(40)}"
        rows.append((k, " ".join(w[rng.randint(0, 25):])))
    rng.shuffle(rows)
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(tuple(r) for r in got.collect()) == brute(rows)
