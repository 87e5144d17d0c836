"""Language identification (numbered operator 11): family first, then pairs of languages within it.

A text becomes the square roots of its shares of hashed byte n-grams (letters only, lower case,
words padded by spaces), a vector of length one. One linear support vector machine per family
tells it from the others; within the family that wins, one machine per pair of languages votes.
Close languages are thus told apart by weights that only they have shaped.

Languages are the values of the label column. Which belong together is a fixed list of language
codes; a value that it does not know is a family of its own. The machines are fitted, a problem
a task, on at most about SAMPLE different texts a language; the driver sees their weights only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.llm.common import pieces, stage, stage_dir

# ---- fixed values (families of language codes) -----------------------------------------
FAMILIES = {
    "germanic": ["af", "da", "de", "en", "fy", "is", "lb", "nb", "nl", "nn", "no", "sv"],
    "romance": ["ca", "es", "fr", "gl", "it", "oc", "pt", "ro"],
    "slavic": ["be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"],
    "baltic": ["lt", "lv"],
    "uralic": ["et", "fi", "hu"],
    "turkic": ["az", "kk", "ky", "tr", "uz"],
    "indo_aryan": ["bn", "gu", "hi", "mr", "ne", "pa", "ur"],
    "dravidian": ["kn", "ml", "ta", "te"],
    "semitic": ["am", "ar", "he", "mt"],
    "austronesian": ["id", "ms", "tl"],
}
# ----------------------------------------------------------------------------------------

#: Different texts of a language that the machines are fitted on, about; and rows of all languages for a family's machine.
SAMPLE = 500
FAMILY_ROWS = 8000
DIM = 4096
GRAMS = (2, 3, 4)
#: Penalty of a margin violation, and passes of dual coordinate descent.
PENALTY = 10.0
PASSES = 30
#: Margin to score: 1 / (1 + exp(-SLOPE * margin)).
SLOPE = 3.0
UNKNOWN = "und"
#: Every fifth document, by the checksum of its id, is held out.
FOLDS = 5

_KEPT = np.array([b if 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256)], np.uint8)
_FACTOR = np.uint32(2654435761)
#: Bytes of one text that are looked at together; longer ones are added up by such parts.
_PART = 1 << 20


def family_of(lang: str) -> str:
    code = lang.strip().lower().replace("_", "-").split("-")[0]
    return next((f for f, codes in FAMILIES.items() if code in codes), f"other {lang}")


def held_out(doc_id: Column) -> Column:
    """Whether the checksum of the id (a missing one counts as empty text) is a multiple of FOLDS."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % F.lit(FOLDS) == 0


def has_letter(text: Column) -> Column:
    return F.coalesce(F.rlike(text, F.lit(r"\p{L}")), F.lit(False))


# --- features ---------------------------------------------------------------------------------


def _counts(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """(documents, DIM) counts of the hashed n-grams of lower-cased texts, one space put before and after each."""
    n = len(off) - 1
    size = np.diff(off)
    doc = np.repeat(np.arange(n, dtype=np.int64), size + 2)
    padded = np.full(len(doc), 32, np.uint8)
    padded[np.arange(len(data)) + 2 * np.repeat(np.arange(n), size) + 1] = _KEPT[data]
    out = np.zeros(n * DIM, np.int64)
    value = padded.astype(np.uint32)
    for g in range(2, max(GRAMS) + 1):
        value = value[:-1] * np.uint32(257) + padded[g - 1:]
        if g in GRAMS:
            ok = (doc[: len(value)] == doc[g - 1:]) & ((padded[: len(value)] != 32) | (padded[1: len(value) + 1] != 32))
            h = ((value + np.uint32(g)) * _FACTOR >> np.uint32(32 - 12)).astype(np.int64)
            out += np.bincount(doc[: len(value)][ok] * DIM + h[ok], minlength=n * DIM)
    return out.reshape(n, DIM)


def features(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """(documents, DIM): square roots of the shares of hashed n-grams."""
    if len(off) == 2 and len(data) > _PART:  # a cut splits one word in a million bytes
        count = sum(_counts(data[a: a + _PART], np.array([0, len(data[a: a + _PART])])) for a in range(0, len(data), _PART))
    else:
        count = _counts(data, off)
    return np.sqrt(count / np.maximum(count.sum(axis=1, keepdims=True), 1)).astype(np.float32)


def _profiles(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Rows with their features; the column ``text`` in lower case."""
    def lower() -> Iterator[pa.RecordBatch]:
        for b in batches:
            k = b.schema.get_field_index("text")
            yield b.set_column(k, "text", pc.utf8_lower(b.column(k).cast(pa.large_string())))

    for rows, data, off in pieces(lower(), most=256):
        yield rows, features(data, off)


# --- machines -----------------------------------------------------------------------------------


def fit_machine(x: np.ndarray, positive: np.ndarray, penalty: float = PENALTY, passes: int = PASSES) -> np.ndarray:
    """Weights (DIM, then bias) of a linear support vector machine with squared hinge loss, by dual coordinate descent.

    Classes weigh the same however many rows they have.
    """
    x = np.concatenate([x, np.ones((len(x), 1), np.float32)], axis=1)
    y = np.where(positive, 1.0, -1.0)
    share = np.where(positive, positive.mean(), 1 - positive.mean())
    slack = share / penalty  # 1 / (2 C) of each row, C in inverse proportion to the class
    norm = (x * x).sum(axis=1) + slack
    w, alpha, rng = np.zeros(x.shape[1], np.float32), np.zeros(len(x)), np.random.RandomState(7)
    for _ in range(passes):
        moved = 0.0
        for i in rng.permutation(len(x)):
            g = y[i] * float(x[i] @ w) - 1 + slack[i] * alpha[i]
            if g < 0 or alpha[i] > 0:
                new = max(alpha[i] - g / norm[i], 0.0)
                step = new - alpha[i]
                if step:
                    w += np.float32(step * y[i]) * x[i]
                    alpha[i] = new
                    moved = max(moved, abs(step))
        if moved < 1e-3:
            break
    return w


def _sample_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, x in _profiles(batches):
        yield pa.RecordBatch.from_arrays([rows.column("lang"), rows.column("k"), pa.array([r.tobytes() for r in x.astype(np.float16)], pa.binary())],
                                         ["lang", "k", "x"])


def _fit_problem(group: pa.Table) -> pa.Table:
    """One problem's rows (problem, positive, k, x) -> its weights; rows are put in order first, so reruns agree."""
    group = group.sort_by([("k", "ascending"), ("positive", "ascending")])
    x = np.stack([np.frombuffer(r, np.float16) for r in group.column("x").to_pylist()]).astype(np.float32)
    w = fit_machine(x, group.column("positive").to_numpy())
    return pa.table({"problem": group.column("problem").slice(0, 1), "w": pa.array([w.tolist()], pa.list_(pa.float64()))})


@dataclass
class LanguageModel:
    """Families with their languages, and the weights of the machines: one per family, one per pair of a family's languages."""

    families: dict[str, list[str]]
    weights: dict[str, np.ndarray]

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        """Language and score of each row of features."""
        names = sorted(self.families)
        margins = np.stack([_margin(x, self.weights[f"family {f}"]) for f in names], axis=1) if len(names) > 1 else np.ones((len(x), 1))
        order = np.argsort(-margins, axis=1, kind="stable")
        lead = margins[np.arange(len(x)), order[:, 0]]
        if len(names) > 1:
            lead = (lead - margins[np.arange(len(x)), order[:, 1]]) / 2
        lang, margin = [""] * len(x), lead.astype(np.float64) if len(names) > 1 else np.full(len(x), np.inf)
        for k, f in enumerate(names):
            rows = np.flatnonzero(order[:, 0] == k)
            if not len(rows):
                continue
            best, gap = self._within(x[rows], self.families[f])
            for i, b in zip(rows, best, strict=True):
                lang[i] = self.families[f][b]
            margin[rows] = np.minimum(margin[rows], gap)
        return lang, 1 / (1 + np.exp(-np.clip(SLOPE * margin, -30, 30)))

    def _within(self, x: np.ndarray, langs: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The language with most pairs won (ties by summed margins) and its least margin over another."""
        m = len(langs)
        if m == 1:
            return np.zeros(len(x), np.int64), np.full(len(x), np.inf)
        won = np.zeros((len(x), m, m))
        for a in range(m):
            for b in range(a + 1, m):
                d = _margin(x, self.weights[f"pair {langs[a]} {langs[b]}"])
                won[:, a, b], won[:, b, a] = d, -d
        votes = (won > 0).sum(axis=2) + np.tanh(won.sum(axis=2)) * .4
        best = votes.argmax(axis=1)
        others = won[np.arange(len(x)), best]
        others[np.arange(len(x)), best] = np.inf
        return best, others.min(axis=1)


def _margin(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return x @ w[:-1] + w[-1]


def train(docs: DataFrame, sample: int = SAMPLE) -> LanguageModel:
    """Fit the machines on ``docs`` (text, lang), rows with a letter and a language.

    About ``sample`` different texts of each language are chosen by their hash, so copies count
    once and neither ids nor sources have a say.
    """
    at = stage_dir(docs.sparkSession)
    rows = docs.where(F.col("lang").isNotNull() & has_letter(F.col("text"))).withColumn("k", F.xxhash64("text"))
    many = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.approx_count_distinct("k", .02).alias("n")).collect()}
    families: dict[str, list[str]] = {}
    for lang in sorted(many):
        families.setdefault(family_of(lang), []).append(lang)
    if len(many) < 2:
        return LanguageModel(families, {})
    parts = 1 << 30
    share = F.create_map(*[F.lit(v) for lang, n in many.items() for v in (lang, int(min(1.0, sample / n) * parts))])
    chosen = rows.where(F.pmod(F.xxhash64("k", F.lit(11)), F.lit(parts)) < share[F.col("lang")]).dropDuplicates(["lang", "k"])
    x = stage(chosen.select("lang", "k", "text").mapInArrow(_sample_rows, "lang string, k long, x binary"), f"{at}/sample")

    each = min(1.0, FAMILY_ROWS / (len(many) * sample))  # a family's machine sees rows of all languages
    tasks = []
    for lang in sorted(many):
        mine = family_of(lang)
        if len(families) > 1:
            tasks += [(lang, f"family {f}", f == mine, each) for f in families]
        for other in families[mine]:
            if other != lang:
                tasks.append((lang, f"pair {min(lang, other)} {max(lang, other)}", lang < other, 1.0))
    problems = docs.sparkSession.createDataFrame(tasks, "lang string, problem string, positive boolean, share double")
    drawn = F.pmod(F.xxhash64("k", F.lit(13)), F.lit(parts)) < F.col("share") * parts
    fitted = x.join(F.broadcast(problems), "lang").where(drawn).select("problem", "positive", "k", "x") \
        .groupBy("problem").applyInArrow(_fit_problem, "problem string, w array<double>").collect()
    return LanguageModel(families, {r["problem"]: np.array(r["w"], np.float32) for r in fitted})


def _predict(model: LanguageModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, x in _profiles(batches):
            lang, score = model.predict(x)
            known = rows.column("known").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [rows.column("row"), pa.array([v if k else UNKNOWN for v, k in zip(lang, known, strict=True)], pa.string()),
                 pa.array(np.where(known, score, 0.0))], ["row", "lang_pred", "score"])

    return run


def identify(docs: DataFrame, keep: list[str], text: str = "text", lang: str = "lang", doc_id: str = "doc_id",
             sample: int = SAMPLE) -> DataFrame:
    """(keep columns, held_out, lang_pred, score) of every row.

    Machines learn from rows with a language whose id is not held out, and see only texts; a
    missing id counts as held out. A null text, one without a letter, and any text where no
    language was learned are ``und`` with score 0. Where one language was learned every other
    text is of it. Texts of any length are judged whole; equal texts alike; an empty table gives
    no rows. Other columns are ignored.
    """
    base = docs.select(F.struct(*[F.col(f"`{c}`").alias(c) for c in keep]).alias("row"), held_out(F.col(f"`{doc_id}`")).alias("held_out"),
                       F.col(f"`{lang}`").cast("string").alias("lang"), F.col(f"`{text}`").alias("text"))
    model = train(base.where(~F.col("held_out")).select("lang", "text"), sample)
    known = has_letter(F.col("text"))
    if not model.families:
        return base.select("row.*", "held_out", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    rows = base.select(F.struct("row", "held_out").alias("row"), "text", known.alias("known"))
    out = rows.mapInArrow(_predict(model), f"row {rows.schema['row'].dataType.simpleString()}, lang_pred string, score double")
    return out.select("row.row.*", "row.held_out", "lang_pred", "score")
