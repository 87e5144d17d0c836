import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from riskspark.llm import language_id as L

WORDS = {"en": "the of and to in is that for with was on as they have from this which".split(),
         "de": "der die und das ist nicht mit von für auf ein eine sich werden auch über".split(),
         "nl": "de het een en van niet met voor zijn aan ook wordt maar naar door over".split(),
         "fr": "le la les des est dans une pour qui sur avec nous vous être plus cette".split(),
         "es": "el los las una que para con por está como más pero sus este entre sobre".split(),
         "xx": "zuq wex qox vuz xaq zzo wuq vex qua zox wuz xox".split()}


def _rows(n, seed=3):
    rng = random.Random(seed)
    langs = sorted(WORDS)
    return [(i, " ".join(rng.choices(WORDS[langs[i % 6]], k=rng.randint(6, 40))).capitalize(), langs[i % 6], f"s{i % 6}") for i in range(n)]


def _plain_features(text):
    """n-gram by n-gram, without numpy."""
    padded = [32, *L._KEPT[np.frombuffer(text.lower().encode(), np.uint8)].tolist(), 32]
    count = [0] * L.DIM
    for g in L.GRAMS:
        for i in range(len(padded) - g + 1):
            gram = padded[i: i + g]
            if gram[0] == 32 and gram[1] == 32:
                continue
            v = 0
            for b in gram:
                v = (v * 257 + b) % 2**32
            count[((v + g) * 2654435761 % 2**32) >> 20] += 1
    total = max(sum(count), 1)
    return np.sqrt(np.array(count) / total)


def test_features_match_a_plain_count():
    texts = ["", "a", "Über den Wolken, 3 x!", "the  cat", "中文 text"]
    raw = [t.lower().encode() for t in texts]
    off = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    got = L.features(np.frombuffer(b"".join(raw), np.uint8), off)
    assert np.allclose(got, np.stack([_plain_features(t) for t in texts]), atol=1e-6)


def test_machine_separates_and_weighs_classes():
    rng = np.random.RandomState(1)
    x = rng.rand(120, 20).astype(np.float32)
    y = x[:, 0] > x[:, 1]
    w = L.fit_machine(x, y, penalty=100, passes=300)
    assert ((x @ w[:-1] + w[-1] > 0) == y).mean() > .97


def test_held_out_accuracy_families_and_plain_prediction(spark):
    rows = _rows(900)
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r["doc_id"]: r for r in L.identify(df, ["doc_id"]).collect()}
    assert len(got) == 900
    out = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5 == 0]
    assert {i for i, r in got.items() if r["held_out"]} == {r[0] for r in out}
    assert np.mean([got[r[0]]["lang_pred"] == r[2] for r in out]) > .95
    assert all(0 <= r["score"] <= 1 for r in got.values())
    # the same model applied text by text: family by its machine, then votes of pairs
    base = df.where(~L.held_out(F.col("doc_id"))).select("lang", "text")
    model = L.train(base)
    assert model.families == {"germanic": ["de", "en", "nl"], "romance": ["es", "fr"], "other xx": ["xx"]}
    assert sum(k.startswith("pair") for k in model.weights) == 4 and sum(k.startswith("family") for k in model.weights) == 3
    for i, text, _, _ in rows[:60]:
        x = _plain_features(text)
        value = {k: float(w[:-1].astype(np.float64) @ x + w[-1]) for k, w in model.weights.items()}
        family = max(sorted(model.families), key=lambda f: value[f"family {f}"])
        langs = model.families[family]
        wins = {a: sum((value[f"pair {a} {b}"] if a < b else -value[f"pair {b} {a}"]) > 0 for b in langs if b != a) for a in langs}
        assert wins[got[i]["lang_pred"]] == max(wins.values()) and got[i]["lang_pred"] in langs


def test_labels_ids_and_sources_are_no_inputs(spark):
    rows = _rows(300)
    held = [zlib.crc32(str(r[0]).encode()) % 5 == 0 for r in rows]
    other = [(i, t, ("zz" if h else lang), ("q" if h else s)) for (i, t, lang, s), h in zip(rows, held, strict=True)]
    schema = "doc_id long, text string, lang string, source string"
    a, b = (sorted(map(tuple, L.identify(spark.createDataFrame(r, schema), ["doc_id"]).collect())) for r in (rows, other))
    assert a == b


def test_nulls_ties_long_texts_and_clashing_names(spark):
    rows = [(i, t, lang, "x", "r", 1.0) for i, t, lang, _ in _rows(120)]
    long_text = " ".join(WORDS["fr"] * 40_000)
    rows += [(900, None, "en", "x", "r", 1.0), (901, "", "en", "x", "r", 1.0), (902, "123 -- !", "de", None, None, None), (903, "der und die nicht", None, "x", "r", .0),
             (904, long_text, None, "x", "r", 1.0), (905, "the of and", "en", "x", "r", 1.0), (905, "the of and", "en", "x", "r", 1.0), (None, "las una que para", "es", "x", "r", 1.0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, row string, known string, score double")
    got = L.identify(df, ["doc_id"]).collect()
    by = {r["doc_id"]: r for r in got}
    assert len(got) == len(rows) and sum(r["doc_id"] == 905 for r in got) == 2
    for i in (900, 901, 902):
        assert by[i]["lang_pred"] == "und" and by[i]["score"] == 0
    assert by[904]["lang_pred"] == "fr" and by[903]["lang_pred"] in WORDS and by[None]["held_out"] and by[None]["lang_pred"] in WORDS
    assert L.identify(df.limit(0), ["doc_id"]).collect() == []
    none = L.identify(df.withColumn("lang", F.lit(None).cast("string")), ["doc_id"]).collect()
    assert len(none) == len(rows) and {r["lang_pred"] for r in none} == {"und"}
    one = L.identify(df.withColumn("lang", F.lit("en")), ["doc_id"]).collect()
    assert {r["lang_pred"] for r in one} == {"en", "und"}
