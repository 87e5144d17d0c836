import hashlib
import itertools
import random
import re

import numpy as np
import pytest

from riskspark.llm import pii
from riskspark.llm.pii import KINDS, Model, Region, base_spans, find_spans, fit, luhn, personal_data, regions

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def by_patterns(t):
    out = []
    for kind, p in PATTERNS.items():
        for m in re.finditer(p, t):
            d = re.sub("[^0-9]", "", m.group())
            if (kind == "email" or (kind == "ip" and all(int(x) <= 255 for x in m.group().split(".")))
                    or (kind == "card" and 13 <= len(d) <= 19 and luhn(d)) or (kind == "phone" and 9 <= len(d) <= 15)):
                out.append((kind, m.start(), m.end()))
    return out


def test_base_matches_patterns():
    rng = random.Random(2)
    bits = ["a@b.co", "@", "a@b", "x.y+z@q-r.s.t", "1.2.3.4", "256.1.1.1", "1.2.3", ".", "4111 1111 1111 1111", "4111-1111-1111-1112", "0", "12",
            "+1 (706) 555-3138", "+", "-", " ", "  ", "é", "_", "0000000000001", "٣", "\n", "(", ")", "001.02.3.4", "word", "+44 20 7946 0958"]
    for _ in range(4000):
        t = "".join(rng.choice(bits) for _ in range(rng.randint(0, 14)))
        assert base_spans(t) == by_patterns(t), t
    for t in ("a" * 200_000, "1" * 200_000, "1." * 100_000, "a@" * 50_000, "+1" * 30_000, "9 " * 90_000):
        base_spans(t)  # time grows with the length


def random_model(seed):
    m, rng = Model(), np.random.RandomState(seed)
    m.segment, m.token, m.move = (rng.randn(*w.shape) for w in (m.segment, m.token, m.move))
    return m


def every_segmentation(r, at=0):
    if at == r.n:
        yield []
        return
    for rest in every_segmentation(r, at + 1):
        yield rest
    for k, (i, j) in enumerate(r.segments):
        if i == at:
            for kind in range(len(KINDS)):
                for rest in every_segmentation(r, j):
                    yield [(i, j, kind, k), *rest]


def score(m, r, segs):
    seg, tok = m.scores(r)
    total, at, y, todo = 0.0, 0, 0, {s[0]: s for s in segs}
    while at < r.n:
        if at in todo:
            _, j, kind, k = todo[at]
            total += seg[k, kind] + m.move[y, kind + 1]
            at, y = j, kind + 1
        else:
            total += tok[at] + m.move[y, 0]
            at, y = at + 1, 0
    return total


@pytest.mark.parametrize("text", ["a1@b.c22", "1234567 89012345", "+1 (5) 5558"])
def test_decoding_and_gradient_match_enumeration(text):
    r, m = Region(text, 0, len(text)), random_model(len(text))
    every = list(every_segmentation(r))
    scores = np.array([score(m, r, s) for s in every])
    assert abs(score(m, r, [(i, j, k, r.segments.index((i, j))) for i, j, k, _ in m.best(r)]) - scores.max()) < 1e-9
    gold = every[int(np.argsort(scores)[len(scores) // 2])]
    g = m.gradient(r, [s[:3] for s in gold])
    for w, gw in zip((m.segment, m.token, m.move), g, strict=True):
        for at in list(itertools.product(*map(range, w.shape)))[::7]:
            ll = []
            for step in (1e-5, -1e-5):
                w[at] += step
                s = np.array([score(m, r, x) for x in every])
                ll.append(score(m, r, gold) - np.logaddexp.reduce(s))
                w[at] -= step
            assert abs((ll[0] - ll[1]) / 2e-5 - gw[at]) < 1e-4


def line(rng):
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8)))
    card = "4" + "".join(str(rng.randrange(10)) for _ in range(14))
    card += next(str(d) for d in range(10) if luhn(card + str(d)))
    item = rng.choice([f"{word()}.{word()}@{word()}.com", ".".join(str(rng.randrange(256)) for _ in range(4)), card,
                       f"+1 ({rng.randrange(200, 900)}) 555-{rng.randrange(1000, 9999)}", f"{rng.randrange(1900, 2030)}", f"{rng.randrange(10000)} {rng.randrange(99)}"])
    return " ".join([word() for _ in range(6)] + [item] + [word() for _ in range(6)])


def test_held_out_forms_are_found():
    rng = random.Random(11)
    model = fit([line(rng) for _ in range(200)])
    right = total = wrong = 0
    nprng = np.random.RandomState(4)
    for _ in range(200):
        t = line(rng)
        text, spans = pii.rewritten(t, base_spans(t), nprng)
        _, found = find_spans(text, model)
        total += len(spans)
        right += sum(s in found for s in spans)
        wrong += sum(not any(a < q and p < b for _, p, q in spans) for _, a, b in found)
        assert set(base_spans(text)) <= set(found)
    assert right > 0.8 * total and wrong < 0.1 * total


def test_query_shape_and_edges(spark):
    rng = random.Random(12)
    rows = [(i, "\n".join(line(rng) for _ in range(3)), "x") for i in range(40)] + [(50, None, ""), (51, "", ""), (None, "a@b.cd", ""), (52, "7 " * 40000, ""), (53, "a@b.cd", ""), (53, "a@b.cd", "")]
    got = {(r["doc_id"], r["base_sha256"], r["n_email"]) for r in personal_data(spark.createDataFrame(rows, "doc_id long, text string, spans string")).collect()}
    assert got == {(d, hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in by_patterns(t or "")).encode()).hexdigest(),
                    sum(s[0] == "email" for s in by_patterns(t or ""))) for d, t, _ in rows}
    assert personal_data(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    assert regions("no digits here") == []


def test_a_megabyte_of_addresses_in_seconds():
    import time

    from riskspark.llm.pii import find_spans, fit

    model = fit(["call +1 555 010 9999 now", "mail a.b@c.org today", "card 4111 1111 1111 1111 ok"])
    text = " ".join(f"user{i}@mail{i % 97}.example.org" for i in range(40_000))
    start = time.time()
    base, every = find_spans(text, model)
    assert len(text) > 1 << 20 and len(base) == 40_000 and every[:1] == base[:1]
    assert time.time() - start < 15  # it grows with the text, not with its square


def test_query_columns_against_the_patterns(spark):
    """Every count, the digest and the listed base spans of all documents; added spans overlap none of them."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
    got = personal_data(docs).collect()
    assert len(got) == len(texts)
    order = {k: i for i, k in enumerate(KINDS)}
    for r in got:
        base = sorted(by_patterns(texts[r["doc_id"]] or ""), key=lambda s: (order[s[0]], s[1]))
        assert [r[f"n_{k}"] for k in KINDS] == [sum(s[0] == k for s in base) for k in KINDS]
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert r["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        spans = [(k, int(a), int(b)) for k, a, b in (x.split(":") for x in r["spans"].split(",") if x)]
        assert set(base) <= set(spans) and spans == sorted(spans, key=lambda s: (order[s[0]], s[1]))
        for k, a, b in set(spans) - set(base):
            assert not any(p < b and a < q for _, p, q in base)
