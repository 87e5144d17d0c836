"""Personal data by a semi-Markov conditional random field (numbered operator 8).

Base spans (email, ip, card, phone) are found by fixed patterns and always stay. Around every
digit or at sign the text is cut into tokens, and a semi-Markov model scores whole candidate
segments: a segment's features see all of it at once (digit count, checksum, parts, separators,
neighbours, cue words), and dynamic programming over segments of at most MAX_TOKENS tokens
chooses boundaries and types together. Segments that the base did not find and that touch no
base span are added.

The model is trained here, by gradient ascent on the conditional likelihood (forward-backward
over segments), on a bounded hashed sample of the documents' own regions labelled by the base
patterns, and on rewritten copies of them (at signs spelled out, prefixes dropped), which teach
it forms that the patterns miss. Inference is local to a row: no shuffle, so no key can be hot.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
#: The longest candidate segment, in tokens and characters.
MAX_TOKENS, MAX_CHARS = 14, 64
#: The shortest, in characters. Segments begin with a letter, a digit, + or (, and end with a letter, a digit or ).
MIN_CHARS = 7
#: Regions of the training sample, and documents that they are taken from (about).
TRAIN_REGIONS, TRAIN_DOCS = 300, 4000
EPOCHS, RATE = 4, 0.15
#: An added segment must score this much above reading its tokens as plain text.
MARGIN = 1.0

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
# a match can only begin where a digit run does: what follows a run is the same from anywhere in it
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TRIGGER = re.compile(r"[0-9@]+|\(at\)|\[at\]")
_TOKEN = re.compile(r"[0-9]+|[^\W\d_]+|[^\S\n]+|.|\n", re.S)
_CUES = {"email": re.compile(r"(?i)(?:e-?mail|contact|write)\W*$"), "ip": re.compile(r"(?i)(?:\bip|host|server|address)\W*$"),
         "card": re.compile(r"(?i)(?:card|visa|credit|account)\W*$"), "phone": re.compile(r"(?i)(?:phone|tel|call|fax|mobile)\W*$")}


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        x = ord(d) - 48
        if k % 2:
            x = 2 * x - 9 * (x > 4)
        total += x
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _small(parts: list[str]) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in parts)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Base spans (kind, start, end), by kind as listed, then start; code points, end exclusive."""
    out = []
    at, free = text.find("@"), 0
    while at >= 0:
        a = at
        while a > free and text[a - 1] in _LOCAL:
            a -= 1
        m = _DOMAIN.match(text, at + 1) if a < at else None
        if m:
            out.append(("email", a, m.end()))
            free = m.end()
        at = text.find("@", max(at + 1, free))
    if _TRIGGER.search(text):
        out += [("ip", m.start(), m.end()) for m in _IP.finditer(text) if _small(m.group().split("."))]
        for m in _CARD.finditer(text):
            d = _digits(m.group()) if m.end() - m.start() <= 37 else ""
            if 13 <= len(d) <= 19 and luhn(d):
                out.append(("card", m.start(), m.end()))
        if "+" in text:
            out += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m.group())) <= 15]
    return out


def regions(text: str) -> list[tuple[int, int]]:
    """Stretches of a line in which a segment can lie: MAX_CHARS around each trigger, joined where they meet."""
    out: list[list[int]] = []
    for m in _TRIGGER.finditer(text):
        a, b = max(0, m.start() - MAX_CHARS), min(len(text), m.end() + MAX_CHARS)
        cut = text.rfind("\n", a, m.start())
        a = cut + 1 if cut >= 0 else a
        cut = text.find("\n", m.end(), b)
        b = cut if cut >= 0 else b
        if out and a <= out[-1][1]:
            out[-1][1] = max(b, out[-1][1])
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


N_FEATURES = 19
_AT, _DOT, _JOINED_LEFT, _JOINED_RIGHT = (re.compile(p) for p in (r"@| ?\(at\) ?| ?\[at\] ?", r"\.|\(dot\)|\[dot\]", r"[\w@.+-]$", r"[\w@]|[.-]\w"))


def span_features(s: str, left: str, right: str) -> np.ndarray:
    """Features of one whole candidate segment with what stands before and after it."""
    d = _digits(s)
    n = len(d)
    ats = _AT.split(s)
    at, dots, parts = len(ats) - 1, len(_DOT.findall(ats[-1])), s.split(".")
    letters = any(c.isalpha() for c in s)
    seps = set(re.sub(r"\w", "", s))
    return np.array([
        1, at == 1, at == 1 and dots > 0, len(parts) == 4 and all(p.isdigit() for p in parts) and _small(parts),
        13 <= n <= 19, 9 <= n <= 15, 13 <= n <= 19 and luhn(d), s[0] == "+", s[0] == "(", not letters and at == 0, letters,
        bool(_JOINED_LEFT.search(left)), bool(_JOINED_RIGHT.match(right)), not (s[0].isalnum() or s[0] in "+("),
        not s[-1].isalnum(), n < 9, len(seps) > 2, " " in s and letters and at == 0, n in (10, 11)], np.float64)


class Region:
    """Tokens of a region and its candidate segments, with their features."""

    def __init__(self, text: str, a: int, b: int):
        self.spans = [(m.start() + a, m.end() + a) for m in _TOKEN.finditer(text[a:b])]
        n = len(self.spans)
        trigger = np.zeros(n + 1, np.int64)
        for k, (x, y) in enumerate(self.spans):
            trigger[k + 1] = trigger[k] + ("0" <= text[x] <= "9" or text[x] == "@" or (text[x:y] == "at" and x > a and text[x - 1] in "(["))
        self.segments: list[tuple[int, int]] = []
        rows = []
        for i, (x, _) in enumerate(self.spans):
            if not (text[x].isalnum() or text[x] in "+("):
                continue
            for j in range(i + 1, min(n, i + MAX_TOKENS) + 1):
                y = self.spans[j - 1][1]
                if y - x > MAX_CHARS:
                    break
                if trigger[j] == trigger[i] or not (text[y - 1].isalnum() or text[y - 1] == ")") or y - x < MIN_CHARS:
                    continue
                s = text[x:y]
                cues = [1.0 * bool(_CUES[k].search(text[max(0, x - 12): x])) for k in KINDS]
                rows.append(np.concatenate([span_features(s, text[max(0, x - 2): x], text[y: y + 2]), cues]))
                self.segments.append((i, j))
        self.features = np.array(rows) if rows else np.zeros((0, N_FEATURES + len(KINDS)))
        self.n = n
        self.plain = np.array([[1.0, text[x].isdigit(), text[x] == "@", len(text[x:y]) >= 9 and text[x].isdigit()] for x, y in self.spans]) \
            if n else np.zeros((0, 4))


class Model:
    """Weights: per kind of segment, per plain token, and between neighbouring labels (0 plain, then the kinds)."""

    def __init__(self):
        self.segment = np.zeros((len(KINDS), N_FEATURES + len(KINDS)))
        self.token = np.zeros(4)
        self.move = np.zeros((1 + len(KINDS), 1 + len(KINDS)))

    def scores(self, r: Region) -> tuple[np.ndarray, np.ndarray]:
        return r.features @ self.segment.T, r.plain @ self.token

    def edges(self, r: Region) -> tuple[list[list[tuple[int, int]]], np.ndarray, np.ndarray]:
        """Segments by end token as (segment index, start), with the scores."""
        by_end: list[list[tuple[int, int]]] = [[] for _ in range(r.n + 1)]
        for k, (i, j) in enumerate(r.segments):
            by_end[j].append((k, i))
        return by_end, *self.scores(r)

    def best(self, r: Region) -> list[tuple[int, int, int, float]]:
        """Highest-scoring segmentation: (start token, end token, kind, margin over plain tokens) of its segments."""
        by_end, seg, tok = self.edges(r)
        top = np.full((r.n + 1, 1 + len(KINDS)), -np.inf)
        top[0, 0] = 0
        back: dict[tuple[int, int], tuple[int, int, int]] = {}
        plain = np.concatenate([[0], np.cumsum(tok)])
        for j in range(1, r.n + 1):
            came = top[j - 1] + self.move[:, 0]
            y = int(np.argmax(came))
            top[j, 0] = came[y] + tok[j - 1]
            back[j, 0] = (j - 1, y, -1)
            for k, i in by_end[j]:
                came = top[i][:, None] + self.move[:, 1:]
                y = np.argmax(came, axis=0)
                for kind in range(len(KINDS)):
                    v = came[y[kind], kind] + seg[k, kind]
                    if v > top[j, kind + 1]:
                        top[j, kind + 1] = v
                        back[j, kind + 1] = (i, int(y[kind]), k)
        out, j, y = [], r.n, int(np.argmax(top[r.n])) if r.n else 0
        while j > 0:
            i, before, k = back[j, y]
            if y:
                out.append((i, j, y - 1, float(seg[k, y - 1] - (plain[j] - plain[i]))))
            j, y = i, before
        return out[::-1]

    def gradient(self, r: Region, gold: list[tuple[int, int, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
        """Gradient of the log likelihood of a segmentation (start, end, kind); None if it is not among the candidates."""
        index = {s: k for k, s in enumerate(r.segments)}
        if any((i, j) not in index for i, j, _ in gold):
            return None
        by_end, seg, tok = self.edges(r)
        y_n = 1 + len(KINDS)
        alpha, beta = np.full((r.n + 1, y_n), -np.inf), np.full((r.n + 1, y_n), -np.inf)
        alpha[0, 0] = 0
        beta[r.n] = 0
        add = np.logaddexp.reduce
        for j in range(1, r.n + 1):
            alpha[j, 0] = add(alpha[j - 1] + self.move[:, 0]) + tok[j - 1]
            if by_end[j]:
                ks, starts = zip(*by_end[j], strict=True)
                into = add(alpha[list(starts)][:, :, None] + self.move[None, :, 1:], axis=1) + seg[list(ks)]
                alpha[j, 1:] = add(into, axis=0)
        by_start: list[list[tuple[int, int]]] = [[] for _ in range(r.n + 1)]
        for k, (i, j) in enumerate(r.segments):
            by_start[i].append((k, j))
        total = add(alpha[r.n])
        g_seg, g_tok, g_move = np.zeros_like(self.segment), np.zeros_like(self.token), np.zeros_like(self.move)
        for i in range(r.n - 1, -1, -1):
            out = [self.move[:, 0] + tok[i] + beta[i + 1, 0]]
            p = np.exp(alpha[i] + out[0] - total)
            g_tok -= p.sum() * r.plain[i]
            g_move[:, 0] -= p
            for k, j in by_start[i]:
                v = self.move[:, 1:] + seg[k][None, :] + beta[j, 1:][None, :]
                p = np.exp(alpha[i][:, None] + v - total)
                g_seg -= p.sum(axis=0)[:, None] * r.features[k][None, :]
                g_move[:, 1:] -= p
                out.append(add(v, axis=1))
            beta[i] = add(np.stack(out), axis=0)
        ends = {i: (j, kind) for i, j, kind in gold}
        i, y = 0, 0
        while i < r.n:
            if i in ends:
                j, kind = ends[i]
                g_seg[kind] += r.features[index[i, j]]
                g_move[y, kind + 1] += 1
                i, y = j, kind + 1
            else:
                g_tok += r.plain[i]
                g_move[y, 0] += 1
                i, y = i + 1, 0
        return g_seg, g_tok, g_move


def _gold(r: Region, spans: list[tuple[str, int, int]]) -> list[tuple[int, int, int]] | None:
    starts, ends = {a: k for k, (a, _) in enumerate(r.spans)}, {b: k + 1 for k, (_, b) in enumerate(r.spans)}
    out, last = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a not in starts or b not in ends:
            return None
        if starts[a] >= last:  # of overlapping kinds the first and longest is the label
            out.append((starts[a], ends[b], KINDS.index(kind)))
            last = ends[b]
    return out


def rewritten(text: str, spans: list[tuple[str, int, int]], rng: np.random.RandomState) -> tuple[str, list[tuple[str, int, int]]]:
    """The region with each span written another way, and where the spans are now."""
    out, now, last = "", [], 0
    for kind, a, b in sorted(spans, key=lambda s: s[1]):
        if a < last:
            continue
        s = text[a:b]
        if kind == "email":
            s = s.replace("@", ["(at)", " (at) ", "[at]"][rng.randint(3)])
        elif kind == "phone":
            s = re.sub(r"^\+[0-9]{1,3}[ .-]?", "", s)
        elif kind == "card":
            s = re.sub(r"[ -]", "", s)
            s = ["-", " ", "."][rng.randint(3)].join(s[k: k + 4] for k in range(0, len(s), 4))
        out += text[last:a]
        now.append((kind, len(out), len(out) + len(s)))
        out, last = out + s, b
    return out + text[last:], now


def fit(samples: list[str], epochs: int = EPOCHS, rate: float = RATE, seed: int = 5) -> Model:
    """Train on region texts; labels are the base spans. Adaptive step sizes, l2 penalty."""
    rng, model, data = np.random.RandomState(seed), Model(), []
    for text in samples:
        spans = base_spans(text)
        for t, s in [(text, spans)] + ([rewritten(text, spans, rng)] if spans else []):
            r = Region(t, 0, len(t))
            gold = _gold(r, s)
            if gold is not None and r.n:
                data.append((r, gold))
    squares = [np.full_like(w, 1e-6) for w in (model.segment, model.token, model.move)]
    for _ in range(epochs):
        for k in rng.permutation(len(data)):
            g = model.gradient(*data[k])
            if g is None:
                continue
            for w, q, x in zip((model.segment, model.token, model.move), squares, g, strict=True):
                x = x - 1e-4 * w
                q += x * x
                w += rate * x / np.sqrt(q)
    return model


def find_spans(text: str, model: Model | None) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Base spans, and base with added spans, both by kind as listed, then start."""
    base = base_spans(text)
    if model is None:
        return base, base
    taken = _Taken(base)
    more = []
    for a, b in regions(text):
        if b - a < 6 or not _hopeful(text, a, b, taken):
            continue
        r = Region(text, a, b)
        for i, j, kind, margin in model.best(r):
            x, y = r.spans[i][0], r.spans[j - 1][1]
            if margin >= MARGIN and not taken.touch(x, y):
                more.append((KINDS[kind], x, y))
    return base, sorted(base + more, key=lambda s: (KINDS.index(s[0]), s[1]))


class _Taken:
    """Base spans in order of their starts, with the largest end so far: each question is one search."""

    def __init__(self, spans: list[tuple[str, int, int]]) -> None:
        order = sorted((a, b) for _, a, b in spans)
        self.starts = [a for a, _ in order]
        self.ends = list(accumulate((b for _, b in order), max))

    def hold(self, x: int, y: int) -> bool:
        """Whether some span contains [x, y)."""
        k = bisect_right(self.starts, x)
        return k > 0 and self.ends[k - 1] >= y

    def touch(self, x: int, y: int) -> bool:
        """Whether some span shares a character with [x, y)."""
        k = bisect_left(self.starts, y)
        return k > 0 and self.ends[k - 1] > x


def _hopeful(text: str, a: int, b: int, taken: _Taken) -> bool:
    """Whether a trigger of the region lies outside every base span; else nothing can be added."""
    return any(not taken.hold(m.start() + a, m.end() + a) for m in _TRIGGER.finditer(text[a:b]))


def _sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = [t[a:b] for t in batch.column("text").to_pylist() if t for a, b in regions(t)]
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["region"])


def train(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", documents: int = TRAIN_DOCS, most: int = TRAIN_REGIONS) -> Model | None:
    """A model from at most ``most`` regions of a hashed sample of about ``documents`` documents; None without any region.

    Regions longer than eight times the longest span (MAX_CHARS) are left out of the fit, so that it is bounded; spans are
    looked for in regions of any length."""
    n = docs.count()
    share = int(min(1.0, documents / max(n, 1)) * (1 << 20))
    src = docs.select(F.col(text_col).alias("text"), F.pmod(F.xxhash64(F.col(id_col), F.octet_length(text_col)), F.lit(1 << 20)).alias("h"))
    found = src.where(F.col("h") < share).select("text").mapInArrow(_sample, "region string").where(F.length("region") <= 8 * MAX_CHARS)
    rows = found.distinct().orderBy(F.xxhash64("region"), "region").limit(most).collect()
    return fit([r["region"] for r in rows]) if rows else None


def _apply(model: Model | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, sha, spans = [[] for _ in KINDS], [], []
            for t in batch.column("text").to_pylist():
                base, every = find_spans(t or "", model)
                for k, kind in enumerate(KINDS):
                    counts[k].append(sum(s[0] == kind for s in base))
                sha.append(hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in base).encode()).hexdigest())
                spans.append(",".join(f"{k}:{a}:{b}" for k, a, b in every))
            yield pa.RecordBatch.from_arrays([batch.column("id"), *(pa.array(c, pa.int64()) for c in counts), pa.array(sha, pa.string()),
                                              pa.array(spans, pa.string())], ["id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

    return run


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_email, n_ip, n_card, n_phone, base_sha256, spans) of every row: counts and digest of the
    base spans, and all spans as ``kind:start:end`` joined by commas.

    Null and empty texts have no spans; null ids and equal rows come back as they are; a text of
    any length is searched whole; without a digit or at sign in the sample nothing is trained
    and nothing added; an empty table gives no rows; other columns are ignored.
    """
    model = train(docs, text_col, id_col)
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    schema = "id long, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string"
    return src.mapInArrow(_apply(model), schema).withColumnRenamed("id", id_col)
