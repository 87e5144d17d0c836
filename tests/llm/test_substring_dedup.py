import hashlib
import random
from collections import Counter

import numpy as np

from riskspark.llm import substring_dedup as S


def brute(rows):
    words = [(d, (t or "").encode().split()) for d, t in rows]
    c = Counter(tuple(w[i:i + 35]) for _, w in words for i in range(len(w) - 34))
    out = []
    for d, w in words:
        gone = set()
        for i in range(len(w) - 34):
            if c[tuple(w[i:i + 35])] > 1:
                gone |= set(range(i, i + 35))
        out.append((d, len(w), len(gone), hashlib.sha256(b" ".join(x for i, x in enumerate(w) if i not in gone)).hexdigest()))
    return sorted(out, key=str)


def test_matches_brute_force(spark, monkeypatch):
    rng = random.Random(6)
    vocab = [f"w{i}" for i in range(3000)]
    passages = [[rng.choice(vocab) for _ in range(n)] for n in (34, 35, 36, 52, 53, 80, 300)]
    rows = []
    for i in range(90):
        w = []
        for _ in range(rng.randint(1, 4)):
            w += [rng.choice(vocab) for _ in range(rng.randint(0, 60))]
            if rng.random() < .7:
                p = list(rng.choice(passages))
                if rng.random() < .3:
                    p[rng.randrange(len(p))] = "changed"
                w += p
        rows.append((i, "".join(x + rng.choice([" ", "\n", "\t ", " "]) for x in w)))
    rows += [(200, "same " * 36), (201, "same " * 35), (202, "a b " * 17), (203, None), (204, ""), (205, " \n"), (206, "é日 x " * 60),
             (207, rows[0][1]), (207, rows[0][1]), (None, rows[1][1]), (208, " ".join(vocab * 10))]
    rng.shuffle(rows)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, batch string, n_words long")
    got = S.substring_dedup(df.repartition(3))
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)
    assert S.substring_dedup(df.limit(0)).collect() == []


def test_hash_lists_round_trip():
    rng = np.random.RandomState(2)
    for bits, n in ((64, 1), (64, 5000), (40, 100000), (24, 3000)):
        u = np.unique(rng.randint(0, 2**62, n, dtype=np.int64).astype(np.uint64) >> np.uint64(62 - min(bits, 62)))
        assert np.array_equal(S._expand(S._squeeze(u)), u)
