import math
import random
import re

import numpy as np
from pyspark.sql import functions as F

from riskspark.llm import quality_model as Q
from riskspark.llm.common import table
from riskspark.llm.quality_model import classify, estimate
from riskspark.llm.quality_rules import quality_rules


def rules_brute(t):
    ws = re.findall(r"[^\x20\x09-\x0D]+", t or "")
    lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    win = [tuple(ws[i:i + 8]) for i in range(len(ws) - 7)]
    hit = set()
    for i, w in enumerate(win):
        if win.count(w) > 1:
            hit |= set(range(i, i + 8))
    base = len(ws) < 20 or 100 * len(hit) > 30 * len(ws)
    return (len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(hit), base)


def test_rules_match_brute_force(spark):
    rng = random.Random(4)
    out = [None, "", "\n \t", "one", "a b c d e f g h " * 30, "w " * 3000, "é日 " * 40, "#" * 50]
    for _ in range(60):
        ws = [rng.choice(["a", "bb", "c.", "#x", "é", "|"]) if rng.random() < .4 else f"w{rng.randrange(500)}" for _ in range(rng.randint(1, 120))]
        k = rng.randrange(len(ws))
        out.append("".join(w + rng.choice([" ", " ", "\n", "\t"]) for w in ws + ws[k:k + rng.randint(0, 30)]))
    rows = [(i, t, "n", 3) for i, t in enumerate(out)] + [(1, "", "n", 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, row string, n_words long")
    got = quality_rules(df, F.col("text")).select("row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert sorted(map(tuple, got.collect())) == sorted((d, *rules_brute(t)) for d, t, _, _ in rows)
    assert quality_rules(df.limit(0), F.col("text")).collect() == []


def test_failed_lines_go(spark):
    good = ["This is a plain sentence of ten words, more or less so.", "Another line here says something else about rivers and hills.",
            "Finally a third one ends the text with eight new words."]
    t = "\n".join([good[0], "Home | Products | About", "WOW!! BUY!! NOW!!", "### ### $$$ %%%", "Read our privacy policy.", good[1], "", good[2]])
    junk = "\n".join(["SALE!! SALE!! TODAY!! ONLY!!", "GO!! " * 40, good[0], good[1]])
    r = quality_rules(spark.createDataFrame([(1, t), (2, junk)], "id long, text string"), F.col("text")).orderBy("row.id").collect()
    assert r[0]["clean_text"] == "\n".join([good[0], good[1], "", good[2]]) and r[0]["kept"] and not r[0]["base_failed"]
    assert r[1]["n_lost_words"] == 44 and not r[1]["kept"]


def test_estimation_finds_accuracies():
    rng = np.random.RandomState(1)
    y = rng.rand(20000) < .8
    accuse = np.array([.7, .5, .6, .4])
    v = np.stack([np.where(y, np.where(rng.rand(y.size) < .02, 2, 0), np.where(rng.rand(y.size) < a, 2, 0)) for a in accuse]
                 + [np.where(rng.rand(y.size) < .1, 0, np.where(rng.rand(y.size) < .9, np.where(y, 1, 2), np.where(y, 2, 1)))], axis=1)
    keys, n = np.unique(v @ 3 ** np.arange(5), return_counts=True)
    post, theta = estimate(dict(zip(keys.tolist(), n.tolist())), 5)
    p = np.array([post[k] for k in (v @ 3 ** np.arange(5)).tolist()])
    assert ((p > .5) == y).mean() > .95
    assert np.all(theta[0, :4, 2] > theta[1, :4, 2] + .2)


def test_classifier_on_held_out_labels(spark):
    d = "/root/testdata/sf0.01"
    docs = table(spark, d, "documents")
    r = classify(docs).select("row.doc_id", "kept").join(table(spark, d, "labels"), "doc_id")
    c = {(x["quality"], x["kept"]): x["n"] for x in r.groupBy("quality", "kept").agg(F.count("*").alias("n")).collect()}
    assert c.get((1, False), 0) <= 0.02 * c[1, True]  # good documents stay
    assert c[0, False] > 0.75 * (c[0, False] + c.get((0, True), 0))


def test_classifier_edges(spark):
    rows = [(1, None, 1.0, "s"), (2, "", 0.0, "s"), (None, " \n", .5, "s"), (3, "word " * 20000, .1, "s"), (3, "word " * 20000, .1, "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, score double, row string")
    r = classify(df).collect()
    assert len(r) == 5 and all(x["kept"] for x in r if not (x["row"]["text"] or "").strip())
    assert len({x["score"] for x in r if x["row"]["doc_id"] == 3}) == 1
    assert classify(df.limit(0)).collect() == []


def _plain_estimate(votes, rounds=Q.ROUNDS):
    """Expectation-maximisation document by document, in plain Python."""
    n, labellers = len(votes), len(votes[0])
    post = [.1 if 2 in v else .9 for v in votes]
    theta = prior = None
    for _ in range(rounds):
        theta = [[[0.0] * 3 for _ in range(labellers)] for _ in range(2)]
        for v, p in zip(votes, post):
            for k, x in enumerate(v):
                theta[0][k][x] += 1 - p
                theta[1][k][x] += p
        for c in range(2):
            for row in theta[c]:
                for x in range(3):
                    row[x] += Q.BELIEF * n * Q._BELIEVED[c][x]
                total = sum(row)
                for x in range(3):
                    row[x] /= total
        prior = (sum(post) + 1) / (n + 2)
        new = []
        for v in votes:
            good, bad = math.log(prior), math.log(1 - prior)
            for k, x in enumerate(v):
                good += math.log(theta[1][k][x])
                bad += math.log(theta[0][k][x])
            new.append(1 / (1 + math.exp(min(max(bad - good, -60), 60))))
        post = new
    return post


def _plain_score(text, weights):
    raw = text.encode()
    m = {k: v[0] for k, v in Q.measures(np.frombuffer(raw, np.uint8), np.array([0, len(raw)])).items()}
    x = [0.0] * Q.DIM
    for a, b in zip(raw, raw[1:]):
        x[((a * 257 + b) * 2654435761 % 2**32) >> 20] += 1
    total = max(sum(x), 1)
    x = [math.sqrt(v / total) for v in x]
    for k, name in enumerate(Q.LABELLERS):
        step = min(int(m[name] * (1 if name == "length" else 10)), 30)
        x[int(Q.mix(np.array([step + 64 * k], np.uint64))[0] % Q.DIM)] += .5
    return 1 / (1 + math.exp(-(sum(w * v for w, v in zip(weights, x)) + weights[-1])))


def test_whole_query_against_a_plain_twin(spark):
    """Posteriors by a loop over documents, scores by a loop over byte pairs with the fitted weights."""
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    rows = [r for r in docs.select("doc_id", "text").collect()]
    got = {r["row"]["doc_id"]: r for r in classify(docs).select("row", "posterior", "score", "kept").collect()}
    votes = []
    for r in rows:
        raw = r["text"].encode()
        votes.append(Q.votes(Q.measures(np.frombuffer(raw, np.uint8), np.array([0, len(raw)])))[0].tolist())
    model = Q.train(docs, F.col("text"), F.col("doc_id"))
    for r, p in zip(rows, _plain_estimate(votes)):
        assert abs(got[r["doc_id"]]["posterior"] - p) < 1e-6
    for r in rows[::7]:
        s = _plain_score(r["text"], model.weights.tolist())
        assert abs(got[r["doc_id"]]["score"] - s) < 2e-3 and got[r["doc_id"]]["kept"] == (got[r["doc_id"]]["score"] >= Q.THRESHOLD)
