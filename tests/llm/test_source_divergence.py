import random
import re
from collections import Counter

from riskspark.llm import source_divergence as S

SCHEMA = "doc_id long, text string, lang string, source string"


def brute(rows, least=S.MIN_DOCS):
    term = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    count, docs, groups = {}, {}, set()
    for _, text, lang, source in rows:
        g = lang or "", source or ""
        groups.add(g)
        words = term.findall((text or "").translate(lower))
        count.setdefault(g, Counter()).update(words)
        docs.setdefault(g[0], Counter()).update(set(words))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in docs[lang].items() if n >= least]
        sources = sorted(s for x, s in groups if x == lang)
        every = Counter()
        for s in sources:
            every.update({t: count[lang, s][t] for t in kept})

        def share(c):
            total = sum(c[t] for t in kept) + 2 * len(kept)
            return {t: 1 + S.SCALE * (c[t] + 2) // total for t in kept}

        f = lambda p, q: (p - q) ** 2 // (p + q)
        p, q = {s: share(count[lang, s]) for s in sources}, share(every)
        for s in sources:
            pairs = [(-sum(f(p[s][t], p[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [(-f(p[s][t], q[t]), t) for t in kept if count[lang, s][t] and p[s][t] > q[t]]
            for part, items in (("pair", sorted(pairs)), ("term", sorted(terms)[:S.TOP])):
                out += [(lang, s, part, item, -v, i + 1) for i, (v, item) in enumerate(items)]
    return sorted(out)


def _rows(seed, n):
    rng = random.Random(seed)
    words = ["the", "The", "Of", "straße", "ÉTÉ", "日本", "x1y", "don't", "a_b", *(f"w{chr(97 + i)}" for i in range(26))]
    weights = [30, 20, 10, *[3] * (len(words) - 3)]
    rows = []
    for i in range(n):
        lang = rng.choice(["en", "en", "en", "de", None, ""])
        source = rng.choice(["hot", "hot", "hot", "s1", "s2", None, "s~", "sé"])
        text = " ".join(rng.choices(words, weights, k=rng.randint(0, 30))) if rng.random() > .05 else None
        rows.append((i, text, lang, source))
    return rows


def test_matches_brute_force_and_blocks_of_groups(spark):
    rows = _rows(4, 400)
    rows += rows[:30] + [(None, "the\x00the;the", "en", "s1"), (7, "", "solo", "only"), (8, "few words", "rare", "a"), (9, "few", "rare", "b")]
    df = spark.createDataFrame(rows, SCHEMA)
    want = brute(rows)
    assert sorted(map(tuple, S.source_divergence(df).collect())) == want
    assert sorted(map(tuple, S.source_divergence(df, at_once=2).collect())) == want
    assert any(r[0] == "rare" and r[4] == 0 for r in want)


def test_small_blocks_pieces_and_segments(spark, monkeypatch):
    rows = _rows(6, 120)
    for name, value in (("RUN_ENTRIES", 20), ("PIECE", 16), ("SEGMENT", 3)):
        monkeypatch.setattr(S, name, value)
    docs = [(lang or "", source or "", (text or "").encode()) for _, text, lang, source in rows]
    segments, block = [], S.Block()
    for lang, source, text in docs:
        seen = set()
        for terms in S._terms(text):
            block.add(lang, source, terms, seen)
            if block.full():
                segments += block.run(5)
                block = S.Block()
    segments += block.run(5)
    assert len(segments) > 50
    got = {(lang, term): (n, found) for lang, term, n, found in S.merge(iter(sorted(segments, key=lambda s: (s["shard"], s["lang"], s["first"]))))}
    want = {}
    for lang, source, text in docs:
        words = [w for x in S._terms(text) for w in x]
        for w in set(words):
            n, found = want.get((lang, w), (0, {}))
            want[lang, w] = n + 1, found | {source: found.get(source, 0) + words.count(w)}
    assert got == want


def test_share_is_exact_beyond_float_precision():
    import numpy as np

    rng = random.Random(1)
    for _ in range(200):
        total = rng.randint(10, 9_000_000_000_000_000)
        count = rng.randint(0, total - 2)
        assert int(S.share(np.array([count]), np.int64(total))[0]) == 1 + S.SCALE * (count + 2) // total


def test_long_text_clashing_names_and_empty_table(spark):
    rows = [(i, "alpha beta " * (200_000 if i == 3 else 1), "en", f"s{i % 2}") for i in range(12)]
    df = spark.createDataFrame([(*r, "a", 1, 2) for r in rows], SCHEMA + ", term string, n int, block int")
    assert sorted(map(tuple, S.source_divergence(df).collect())) == brute(rows)
    assert S.source_divergence(df.limit(0)).collect() == []
