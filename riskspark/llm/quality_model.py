"""Quality classifier from weak labels (numbered operator 1).

Overlapping heuristic labellers vote good, bad or nothing on every document. Votes of all
documents are counted by pattern (at most 3^labellers patterns, whatever the corpus), and
expectation-maximisation on those counts estimates each labeller's accuracy per class and the
class shares without a single true label. The posterior of a document's pattern is its soft
label; a bounded hashed sample of documents with those labels trains a linear scorer on hashed
byte pairs and bucketed measures, which then scores every document.

Votes are counted with map-side sums; the driver sees only pattern counts and the weights.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.llm.common import inside, mix, pieces, stage, stage_dir, window_hashes, word_hashes, word_spans

#: The scorer is fitted on about so many documents (and never more than twice as many).
SAMPLE = 4000
DIM = 4096
THRESHOLD = 0.5
ROUNDS = 60
#: Votes (none, good, bad) that labellers are believed to give on bad and on good documents before any are seen, and the
#: weight of that belief, in shares of the documents: labellers are better than chance, and seldom accuse a good one.
_BELIEVED = np.array([[.6, .2, .2], [.5, .499, .001]])
BELIEF = .05
STEPS = 300

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_STOP = np.zeros(256, dtype=bool)
_STOP[[ord(c) for c in ".,;:?"]] = True
_RANGE = lambda a, b: np.isin(np.arange(256), np.arange(ord(a), ord(b) + 1))
_UPPER, _LETTER = _RANGE("A", "Z"), _RANGE("A", "Z") | _RANGE("a", "z")


def _per_doc(flags: np.ndarray, off: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags)])
    return total[off[1:]] - total[off[:-1]]


def _repeated(hashes: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """Share of a document's values that repeat an earlier one of the document."""
    _, first = np.unique(mix(hashes ^ mix(doc.astype(np.uint64) + np.uint64(1))), return_index=True)
    count = np.bincount(doc, minlength=n)
    return 1 - np.bincount(doc[first], minlength=n) / np.maximum(count, 1) * (count > 0) - (count == 0)


def measures(data: np.ndarray, off: np.ndarray) -> dict[str, np.ndarray]:
    """Cheap measures of each document, all in one pass over the bytes."""
    n = len(off) - 1
    starts, ends, word_off = word_spans(data, off)
    words = np.diff(word_off)
    some = np.maximum(words, 1)
    word_doc = np.repeat(np.arange(n), words)
    of_words = lambda flags: np.bincount(word_doc[flags], minlength=n) / some
    last = data[ends - 1] if len(ends) else np.zeros(0, np.uint8)
    before = np.where(ends - starts > 1, data[np.maximum(ends - 2, 0)], 0) if len(ends) else last
    h = word_hashes(data, starts, ends)
    rolled = window_hashes(h, 8)
    ok = inside(word_off, 8, len(h))
    newline = data == 10
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[off] = True
    line_start = np.flatnonzero((edge[:-1] | np.concatenate([[False], newline[:-1]])) & ~newline) if len(data) else np.zeros(0, np.int64)
    line_end = np.flatnonzero((edge[1:] | np.concatenate([newline[1:], [False]])) & ~newline) + 1 if len(data) else line_start
    line_doc = np.searchsorted(off, line_start, "right") - 1
    letters = np.maximum(_per_doc(_LETTER[data], off), 1)
    return {
        "words": words,
        "upper": _per_doc(_UPPER[data], off) / letters,
        "symbols": _per_doc(_SYMBOL[data], off) / some,
        "shouts": of_words((last == 33) & (before == 33)),
        "odd_ends": of_words(_SYMBOL[last]) if len(last) else np.zeros(n),
        "stops": of_words(_STOP[last]) if len(last) else np.zeros(n),
        "length": np.bincount(word_doc, ends - starts, minlength=n) / some,
        "windows": _repeated(rolled[ok], word_doc[: len(ok)][ok], n),
        "lines": _repeated(word_hashes(data, line_start, line_end), line_doc, n),
    }


#: Labellers, one per measure. Votes: 0 none, 1 good, 2 bad. Each looks at one kind of fault, so most only accuse.
LABELLERS = ("upper", "symbols", "shouts", "odd_ends", "stops", "length", "windows", "lines")


def votes(m: dict[str, np.ndarray]) -> np.ndarray:
    """(documents, labellers) votes; a document without words gets none."""
    accuse = lambda bad: np.where(bad, 2, 0)
    judge = lambda good, bad: np.where(bad, 2, np.where(good, 1, 0))
    v = np.stack([
        accuse(m["upper"] > .5),
        accuse(m["symbols"] > .2),
        accuse(m["shouts"] > .3),
        accuse(m["odd_ends"] > .15),
        judge((m["stops"] > .03) & (m["stops"] < .3), (m["stops"] == 0) & (m["words"] > 40)),
        judge((m["length"] > 3) & (m["length"] < 8), (m["length"] < 1.5) | (m["length"] > 14)),
        accuse(m["windows"] > .3),
        accuse(m["lines"] > .4),
    ], axis=1).astype(np.int64)
    v[m["words"] == 0] = 0
    return v


def features(data: np.ndarray, off: np.ndarray, m: dict[str, np.ndarray]) -> np.ndarray:
    """(documents, DIM) hashed features: root shares of byte pairs, and one indicator per bucketed measure."""
    n = len(off) - 1
    out = np.zeros((n, DIM), np.float32)
    if len(data) > 1:
        pair = (data[:-1].astype(np.uint32) * np.uint32(257) + data[1:]) * np.uint32(2654435761) >> np.uint32(32 - 12)
        doc = np.repeat(np.arange(n, dtype=np.int64), np.diff(off))
        same = doc[:-1] == doc[1:]
        count = np.bincount(doc[:-1][same] * DIM + pair[same], minlength=n * DIM).reshape(n, DIM)
        out = np.sqrt(count / np.maximum(count.sum(axis=1, keepdims=True), 1)).astype(np.float32)
    for k, name in enumerate(LABELLERS):
        step = np.minimum((m[name] * (1 if name == "length" else 10)).astype(np.int64), 30)
        at = (mix((step + 64 * k).astype(np.uint64)) % np.uint64(DIM)).astype(np.int64)
        out[np.arange(n), at] += np.float32(.5)
    return out


def _pattern(v: np.ndarray) -> np.ndarray:
    return v @ (3 ** np.arange(v.shape[1]))


def estimate(patterns: dict[int, int], labellers: int = len(LABELLERS), rounds: int = ROUNDS) -> tuple[dict[int, float], np.ndarray]:
    """Posterior of good for each vote pattern, and (2, labellers, 3) vote probabilities per class, from pattern counts.

    Starts from good unless anyone accuses; the prior belief in the labellers keeps every probability positive.
    A pattern without votes gets the prior.
    """
    keys = np.array(sorted(patterns), np.int64)
    n = np.array([patterns[k] for k in keys], np.float64)
    v = keys[:, None] // 3 ** np.arange(labellers) % 3
    one_hot = np.eye(3)[v]
    post = np.where((v == 2).any(axis=1), .1, .9)
    for _ in range(rounds):
        weight = np.stack([n * (1 - post), n * post])
        theta = np.einsum("cp,plv->clv", weight, one_hot) + BELIEF * n.sum() * _BELIEVED[:, None, :]
        theta /= theta.sum(axis=2, keepdims=True)
        prior = (weight.sum(axis=1) + 1) / (n.sum() + 2)
        log = np.log(prior) + np.einsum("plv,clv->pc", one_hot, np.log(theta))
        post = 1 / (1 + np.exp(np.clip(log[:, 0] - log[:, 1], -60, 60)))
    return dict(zip(keys.tolist(), post.tolist(), strict=True)), theta


def fit(x: np.ndarray, y: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """Logistic weights (DIM, then bias) for soft labels, classes weighing the same, by gradient descent with momentum."""
    w, speed = np.zeros(x.shape[1] + 1), np.zeros(x.shape[1] + 1)
    weight = np.where(y > .5, .5 / max((y > .5).sum(), 1), .5 / max((y <= .5).sum(), 1))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -30, 30)))
        g = (p - y) * weight
        grad = np.append(g @ x, g.sum()) + 1e-5 * np.append(w[:-1], 0)
        speed = .9 * speed - 3.0 * grad
        w += speed
    return w


@dataclass
class QualityModel:
    """Vote-pattern posteriors, estimated vote probabilities and scorer weights."""

    posterior: dict[int, float]
    theta: np.ndarray
    weights: np.ndarray

    def scorer(self):
        """Arrow UDF text -> struct(posterior, score)."""
        posterior, w = self.posterior, self.weights

        @F.arrow_udf("struct<posterior:double,score:double>")
        def score(text: pa.Array) -> pa.Array:
            batch = pa.RecordBatch.from_arrays([text], ["text"])
            weak, out = [], []
            for _, data, off in pieces(iter([batch]), most=512):
                m = measures(data, off)
                weak += [posterior.get(k, .5) for k in _pattern(votes(m)).tolist()]
                out.append(1 / (1 + np.exp(-np.clip(features(data, off, m) @ w[:-1] + w[-1], -30, 30))))
            return pa.StructArray.from_arrays([pa.array(weak, pa.float64()), pa.array(np.concatenate([np.zeros(0), *out]))],
                                              ["posterior", "score"])

        return score


def _observe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, data, off in pieces(batches, most=512):
        m = measures(data, off)
        x = features(data, off, m).astype(np.float16) if any(rows.column("sampled").to_pylist()) else None
        chosen = rows.column("sampled").to_pylist()
        yield pa.RecordBatch.from_arrays(
            [pa.array(_pattern(votes(m))), pa.array([x[i].tobytes() if s else None for i, s in enumerate(chosen)], pa.binary())],
            ["pattern", "x"])


def _fit_rows(posterior: dict[int, float]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [(b.column("x")[i].as_py(), posterior[b.column("pattern")[i].as_py()]) for b in batches for i in range(b.num_rows)]
        if rows:
            x = np.stack([np.frombuffer(r[0], np.float16) for r in rows]).astype(np.float32)
            w = fit(x, np.array([r[1] for r in rows]))
            yield pa.RecordBatch.from_arrays([pa.array([w.tolist()], pa.list_(pa.float64()))], ["w"])

    return run


def train(docs: DataFrame, text: Column, key: Column, sample: int = SAMPLE) -> QualityModel:
    """Estimate labeller accuracies on all of ``docs`` and fit the scorer on a hashed sample of at most 2 * ``sample`` of them.

    An empty table gives a model that scores everything 0.5.
    """
    n = docs.count()
    share = min(1.0, sample / max(n, 1))
    sampled = F.pmod(F.xxhash64(key, F.octet_length(text)), F.lit(1 << 20)) < F.lit(int(share * (1 << 20)))
    seen = stage(docs.select(text.alias("text"), F.coalesce(sampled, F.lit(False)).alias("sampled"))
                 .mapInArrow(_observe, "pattern long, x binary"), f"{stage_dir(docs.sparkSession)}/votes")
    counts = {r["pattern"]: r["n"] for r in seen.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return QualityModel({}, np.full((2, len(LABELLERS), 3), 1 / 3), np.zeros(DIM + 1))
    posterior, theta = estimate(counts)
    # one bounded task: at most 2 * sample rows of 8 kB
    rows = seen.where(F.col("x").isNotNull()).limit(2 * sample).repartition(1).mapInArrow(_fit_rows(posterior), "w array<double>").collect()
    return QualityModel(posterior, theta, np.array(rows[0]["w"]) if rows else np.zeros(DIM + 1))


def classify(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", sample: int = SAMPLE) -> DataFrame:
    """(row, posterior, score, kept) of every row, the row itself as a struct.

    ``posterior`` is what the labellers say after estimation, ``score`` the linear scorer's
    probability of good, ``kept`` whether it reaches THRESHOLD.

    Null, empty and wordless texts are kept with score 1 and posterior null: there is nothing
    to judge. A text of any length is judged whole. Equal rows score alike. An empty table
    gives no rows. Input columns come back inside ``row`` whatever their names.
    """
    model = train(docs, F.col(text_col), F.col(id_col), sample)
    out = docs.select(F.struct("*").alias("row"), F.col(text_col).alias("text"))
    out = out.withColumn("q", model.scorer()(F.col("text")))
    blank = ~F.coalesce(F.rlike("text", F.lit(r"[^\x20\x09-\x0D]")), F.lit(False))
    out = out.select("row", F.when(~blank, F.col("q.posterior")).alias("posterior"),
                     F.when(blank, F.lit(1.0)).otherwise(F.col("q.score")).alias("score"))
    return out.withColumn("kept", F.col("score") >= THRESHOLD)
