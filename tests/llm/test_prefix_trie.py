import hashlib
import math
import random
import zlib

from riskspark.llm import prefix_trie as P

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    convs = {}
    for c, t, r, x in rows:
        if c is not None:
            convs.setdefault(c, []).append(((t is not None, t or 0), r or "", x or ""))
    convs = {c: [(r, x) for _, r, x in sorted(v)] for c, v in convs.items()}
    full = {}
    for c, v in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        full[c] = tuple(convs.get(c - int(math.fmod(c, 5)), [])[:h] + v[h:])
    node, kids = {}, {}
    for c, s in full.items():
        for d in range(len(s) + 1):
            node.setdefault(s[:d], []).append(c)
    for s in node:
        if s:
            kids.setdefault(s[:-1], []).append(s)
    out, done = [], {}
    for s in sorted(node, key=len, reverse=True):
        k = kids.get(s, [])
        leaves = sum(done[x][0] for x in k) or 1
        saved = sum(done[x][1] for x in k) + ((len(node[s]) - 1) * len(s[-1][1].encode()) if s else 0)
        done[s] = leaves, saved
        ends = ",".join(str(c) for c in sorted(node[s]) if len(full[c]) == len(s))
        out.append((min(node[s]), len(s), min(node[s[:-1]]) if s else None, len(node[s]), len(k), leaves, saved,
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def _rows(seed, convs, alphabet, longest):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-40, 400), convs):
        for t in range(rng.randint(1, longest)):
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", rng.choice(alphabet)))
    return rows


def _run(spark, rows):
    return sorted((tuple(r) for r in P.prefix_trie(spark.createDataFrame(rows, SCHEMA)).collect()), key=str)


def test_matches_brute_force_over_many_shards(spark):
    rows = _rows(1, 150, ["a", "bé", "ccc"], 12) + [(500 + i, t, "user", x) for i in range(60) for t, x in enumerate("hello there you".split())]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for shards in ("1", "4", "23"):
            spark.conf.set("spark.sql.shuffle.partitions", shards)
            assert _run(spark, rows) == brute(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_nulls_ties_turnless_and_deep_conversations(spark):
    rows = [(1, None, None, None), (1, 3, "user", None), (1, 3, "user", "x"), (1, 3, "user", "x"), (None, 0, "user", "lost"),
            (0, 0, "user", "top"), (7, 0, "a", ""), (11, 0, "a", "y")]
    rows += [(900, t, "user", f"t{t % 3}") for t in range(1500)] + [(901, t, "user", f"t{t % 3}") for t in range(1400)]
    random.Random(2).shuffle(rows)
    want = brute(rows)
    assert _run(spark, rows) == want
    assert any(r[1] == 0 and r[7] != P.NO_ENDS for r in want), "one conversation is turnless"
    assert max(r[1] for r in want) > 1300


def test_clashing_names_and_empty_table(spark):
    rows = _rows(5, 20, ["a", "b"], 4)
    df = spark.createDataFrame([(*r, 1, "z", 2) for r in rows], SCHEMA + ", conv int, key string, place int")
    assert sorted((tuple(r) for r in P.prefix_trie(df).collect()), key=str) == brute(rows)
    assert P.prefix_trie(df.limit(0)).collect() == []


def test_median_first_is_balanced():
    assert sorted(P.median_first(100)) == list(range(100))
    tree = P.TernaryTree()
    for i in P.median_first(1023):
        tree.insert([i], [1], 1, i, "")
    longest, stack = 0, [(tree.top, 1)]
    while stack:
        at, d = stack.pop()
        longest = max(longest, d)
        stack += [(x, d + 1) for x in (tree.left[at], tree.right[at]) if x >= 0]
    assert longest == 10


def test_edges_of_neighbour_shards_merge():
    seqs = [([1], 2), ([1, 2], 1), ([1, 2, 3], 1), ([1, 4], 5), ([2], 1)]
    rows = [(s, [10] * len(s), n, 100 + i, f"e{i}") for i, (s, n) in enumerate(seqs)]
    import pyarrow as pa

    for cut in range(len(rows) + 1):
        nodes = [n for part in (rows[:cut], rows[cut:]) for n in P.shard_nodes(part)]
        edges = [n for n in nodes if n["own_key"]]
        merged = [m for f in {n["first"] for n in edges}
                  for m in P.merge_edges(pa.Table.from_pylist([n for n in edges if n["first"] == f], P._ARROW_NODE)).to_pylist()]
        got = sorted((n["depth"], n["conv_id"], n["n_convs"], n["n_children"], n["n_leaves"], n["saved"], n["ends"])
                     for n in [*merged, *(n for n in nodes if not n["own_key"])])
        assert got == [(1, 100, 9, 2, 2, 80 + 10 + 0 + 40, "e0"), (1, 104, 1, 0, 1, 0, "e4"), (2, 101, 2, 1, 1, 10, "e1"),
                       (2, 103, 5, 0, 1, 40, "e3"), (3, 102, 1, 0, 1, 0, "e2")]
