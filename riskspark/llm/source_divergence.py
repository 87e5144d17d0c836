"""Source divergence audit (numbered operator 13): single-pass in-memory indexing.

Every language keeps the terms of at least MIN_DOCS of its documents. Each source of a
language, and the language itself, gives each kept term a smoothed share; how two of them
differ over all kept terms is the audit, with the terms that a source uses most beyond its
language.

One pass over the text. A task reads documents into a block of postings (term -> occurrences
per source, and documents) until the block holds RUN_ENTRIES entries or RUN_BYTES bytes of
terms, then writes it out as a run: its terms, sorted, dealt to shards by their hash and cut
into segments. A shard's task gets its segments in the order of their first terms and merges
them by a heap that holds only the segments open at the moment, so its memory is bounded by
segments, not by the vocabulary; a term of all runs is a sum of small postings.

A term that neither of two sources uses adds the same amount for this pair, whatever the term.
So pairs start from that amount times all kept terms, and one pass over the merged frequencies
streams the corrections of terms that one of them uses, added up in the task.

All numbers are integers of 64 bits and exact up to 9e15 occurrences a language.
"""

from __future__ import annotations

import heapq
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskspark.llm.common import stage, stage_dir

MIN_DOCS = 10
TOP = 10
SCALE = 1_000_000_000
#: A block of postings ends when it holds so many entries, or terms of so many bytes.
RUN_ENTRIES = 1 << 20
RUN_BYTES = 128 << 20
#: Terms in a segment, the unit in which a run travels and is merged.
SEGMENT = 2048
#: Text bytes a shard stands for.
SHARD_BYTES = 128 << 20
#: A long text is split into terms by pieces of about so many bytes.
PIECE = 4 << 20
#: Groups whose totals travel with one pass of corrections; with more, pairs of such blocks have passes of their own.
GROUPS_AT_ONCE = 1024

#: Bytes of a term stay (A-Z lower-cased), any other byte ends it.
_TERM = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

_RUN = "shard int, lang string, first binary, terms array<binary>, docs array<long>, ends array<int>, " \
       "names array<string>, which array<int>, counts array<long>"
_ARROW_RUN = pa.schema([("shard", pa.int32()), ("lang", pa.string()), ("first", pa.binary()), ("terms", pa.list_(pa.binary())),
                        ("docs", pa.list_(pa.int64())), ("ends", pa.list_(pa.int32())), ("names", pa.list_(pa.string())),
                        ("which", pa.list_(pa.int32())), ("counts", pa.list_(pa.int64()))])
_FREQUENCY = "lang string, term string, names array<string>, counts array<long>"
_ARROW_FREQUENCY = pa.schema([("lang", pa.string()), ("term", pa.string()), ("names", pa.list_(pa.string())),
                              ("counts", pa.list_(pa.int64()))])
_FOUND = "part string, lang string, source string, item string, value long"
_ARROW_FOUND = pa.schema([("part", pa.string()), ("lang", pa.string()), ("source", pa.string()), ("item", pa.string()),
                          ("value", pa.int64())])


# --- runs ----------------------------------------------------------------------------------


def _terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, in pieces that do not cut one."""
    a = 0
    while a < len(text):
        b = min(a + PIECE, len(text))
        while b < len(text) and _TERM[text[b]] != 32:
            b += 1
        yield text[a:b].translate(_TERM).split()
        a = b


class Block:
    """Postings of the documents read since the last run."""

    def __init__(self) -> None:
        self.counts: dict[str, dict[str, Counter]] = {}
        self.docs: dict[str, Counter] = {}
        self.entries = self.bytes = 0

    def add(self, lang: str, source: str, terms: list[bytes], seen: set[bytes]) -> None:
        """Some terms of a document; ``seen`` are those it had before, in this block or in one written out."""
        count = self.counts.setdefault(lang, {}).setdefault(source, Counter())
        docs = self.docs.setdefault(lang, Counter())
        before = len(count) + len(docs)
        count.update(terms)
        new = set(terms)
        new -= seen
        docs.update(new)
        seen |= new
        self.entries += len(count) + len(docs) - before
        self.bytes += sum(map(len, new))

    def full(self) -> bool:
        return self.entries >= RUN_ENTRIES or self.bytes >= RUN_BYTES

    def run(self, shards: int) -> Iterator[dict]:
        """The block as term-sorted segments of each shard and language."""
        for lang in sorted(self.counts):
            names = sorted(self.counts[lang])
            counters = [self.counts[lang][name] for name in names]
            terms = sorted(set().union(*counters))
            number = {t: i for i, t in enumerate(terms)}
            # postings by term, then source
            term = np.concatenate([np.fromiter(map(number.__getitem__, c), np.int64, len(c)) for c in counters])
            order = np.argsort(term, kind="stable")
            which = np.repeat(np.arange(len(names), dtype=np.int32), [len(c) for c in counters])[order]
            count = np.concatenate([np.fromiter(c.values(), np.int64, len(c)) for c in counters])[order]
            begin = np.searchsorted(term[order], np.arange(len(terms) + 1))
            seen, seed = self.docs[lang], zlib.crc32(lang.encode("utf-8"))
            docs = np.fromiter((seen.get(t, 0) for t in terms), np.int64, len(terms))
            shard = np.fromiter((zlib.crc32(t, seed) % shards for t in terms), np.int64, len(terms))
            dealt = np.argsort(shard, kind="stable")
            for mine in np.split(dealt, np.flatnonzero(np.diff(shard[dealt])) + 1):
                for a in range(0, len(mine), SEGMENT):
                    part = mine[a: a + SEGMENT]
                    n = begin[part + 1] - begin[part]
                    ends = np.cumsum(n)
                    rows = np.repeat(begin[part] - (ends - n), n) + np.arange(ends[-1])
                    used, at = np.unique(which[rows], return_inverse=True)
                    yield {"shard": int(shard[part[0]]), "lang": lang, "first": terms[part[0]], "terms": [terms[i] for i in part],
                           "docs": docs[part], "ends": ends, "names": [names[k] for k in used], "which": at, "counts": count[rows]}


def _index(shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = Block()
        for batch in batches:
            langs, sources = batch.column("lang").to_pylist(), batch.column("source").to_pylist()
            text = batch.column("text").cast(pa.large_binary())
            for i, (lang, source) in enumerate(zip(langs, sources, strict=True)):
                seen: set[bytes] = set()
                for terms in _terms(text[i].as_py()):
                    block.add(lang, source, terms, seen)
                    if block.full():
                        yield from _batches(block.run(shards), _ARROW_RUN, 256)
                        block = Block()
        yield from _batches(block.run(shards), _ARROW_RUN, 256)

    return run


def _batches(rows: Iterator[dict], schema: pa.Schema, size: int) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


# --- merge ---------------------------------------------------------------------------------


def _postings(segment: dict) -> Iterator[tuple[bytes, int, list[str], list[int]]]:
    """(term, documents, sources, counts) of a segment, in order."""
    a, names = 0, segment["names"]
    for term, docs, b in zip(segment["terms"], segment["docs"], segment["ends"], strict=True):
        yield term, docs, [names[k] for k in segment["which"][a:b]], segment["counts"][a:b]
        a = b


def merge(segments: Iterator[dict]) -> Iterator[tuple[str, bytes, int, dict[str, int]]]:
    """(lang, term, documents, occurrences by source) from segments in order of (shard, lang, first term).

    A heap holds the next posting of each open segment; a segment opens when the heap's least
    term has reached its first one.
    """
    heap: list[tuple] = []
    term, docs, found = None, 0, {}
    lang = here = None

    def drain(until: bytes | None) -> Iterator[tuple]:
        nonlocal term, docs, found
        while heap and (until is None or heap[0][0] < until):
            t, k, row, rows = heap[0]
            after = next(rows, None)
            if after is None:
                heapq.heappop(heap)
            else:
                heapq.heapreplace(heap, (after[0], k, after, rows))
            if t != term:
                if term is not None:
                    yield lang, term, docs, found
                term, docs, found = t, 0, {}
            docs += row[1]
            for name, n in zip(row[2], row[3], strict=True):
                found[name] = found.get(name, 0) + n
        if until is None and term is not None:
            yield lang, term, docs, found
            term = None

    for k, segment in enumerate(segments):
        if (segment["shard"], segment["lang"]) != here:
            yield from drain(None)
            here, lang = (segment["shard"], segment["lang"]), segment["lang"]
        else:
            yield from drain(segment["first"])
        rows = _postings(segment)
        row = next(rows)  # a segment has a term
        heapq.heappush(heap, (row[0], k, row, rows))
    yield from drain(None)


def _merge(min_docs: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def cell(column: pa.Array, i: int):  # numbers by way of numpy
            return column[i].values.to_numpy().tolist() if pa.types.is_list(column.type) and pa.types.is_integer(column.type.value_type) else column[i].as_py()

        segments = ({c: cell(b.column(c), i) for c in _ARROW_RUN.names} for b in batches for i in range(b.num_rows))
        kept = ({"lang": lang, "term": term.decode("utf-8"), "names": list(found), "counts": list(found.values())}
                for lang, term, docs, found in merge(segments) if docs >= min_docs)
        yield from _batches(kept, _ARROW_FREQUENCY, 4096)

    return run


def frequencies(docs: DataFrame, shards: int, min_docs: int = MIN_DOCS) -> DataFrame:
    """(lang, term, names, counts) of each kept term: occurrences by source of its language. ``docs`` has lang, source, text without nulls."""
    runs = docs.select("lang", "source", "text").mapInArrow(_index(shards), _RUN)
    dealt = runs.repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "lang", "first")
    return dealt.mapInArrow(_merge(min_docs), _FREQUENCY)


# --- corrections ---------------------------------------------------------------------------


def share(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(SCALE * (count + 2) / total), exact in 64 bits: three digits at a time."""
    left, out = np.asarray(count, np.int64) + 2, np.int64(0)
    for _ in range(3):
        left = left * 1000
        out = out * 1000 + left // total
        left = left % total
    return out + 1


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    d = p - q
    return d * d // (p + q)


def _dense(at: np.ndarray, term: np.ndarray, counts: np.ndarray, n: int, width: int) -> np.ndarray:
    out = np.zeros((n, width), np.int64)
    ok = at >= 0
    out[term[ok], at[ok]] = counts[ok]
    return out


class _Language:
    """Groups of one language in this pass, and what has been added up for them."""

    def __init__(self, left: list[tuple[str, int]], right: list[tuple[str, int]] | None, total: int, kept: int) -> None:
        self.same = right is None
        self.names = [[g[0] for g in left], [g[0] for g in (left if self.same else right)]]
        d = [np.array([g[1] for g in side], np.int64) + 2 * kept for side in (left, left if self.same else right)]
        self.d, self.total = d, np.int64(total + 2 * kept)
        zero = [share(np.zeros(len(x), np.int64), x) for x in d]
        self.base = distance(zero[0][:, None], zero[1][None, :])
        self.sum = np.zeros_like(self.base)
        self.top: list[list[tuple[int, str]]] = [[] for _ in left]

    def add(self, terms: list[str], of: np.ndarray, names: pa.Array, counts: np.ndarray) -> None:
        """Terms with their postings (term number, source, occurrences)."""
        sides = [pc.fill_null(pc.index_in(names, pa.array(x, pa.string())), -1).to_numpy(zero_copy_only=False)
                 for x in self.names]
        every = np.bincount(of, counts, len(terms)) if counts.sum() < 1 << 52 else None
        lang = every.astype(np.int64) if every is not None else np.array(
            [counts[of == i].sum() for i in range(len(terms))], np.int64)
        step = max(1, (1 << 20) // max(self.base.shape))
        for a in range(0, len(terms), step):
            b = min(a + step, len(terms))
            lo, hi = np.searchsorted(of, [a, b])
            c = [_dense(s[lo:hi], of[lo:hi] - a, counts[lo:hi], b - a, len(x)) for s, x in zip(sides, self.names, strict=True)]
            p = [share(x, d) for x, d in zip(c, self.d, strict=True)]
            for g in range(c[0].shape[1]):  # terms that g uses
                rows = np.flatnonzero(c[0][:, g])
                self.sum[g] += distance(p[0][rows, g][:, None], p[1][rows]).sum(axis=0) - len(rows) * self.base[g]
            for h in range(c[1].shape[1]):  # terms that h uses and g does not
                rows = np.flatnonzero(c[1][:, h])
                free = c[0][rows] == 0
                gain = distance(p[1][rows, h][:, None], p[0][rows]) - self.base[:, h]
                self.sum[:, h] += np.where(free, gain, 0).sum(axis=0)
            if self.same:
                self._highest(terms[a:b], c[0], p[0], share(lang[a:b], self.total))

    def _highest(self, terms: list[str], c: np.ndarray, p: np.ndarray, q: np.ndarray) -> None:
        for g in range(c.shape[1]):
            rows = np.flatnonzero((c[:, g] > 0) & (p[:, g] > q))
            if not len(rows):
                continue
            f = distance(p[rows, g], q[rows])
            if len(rows) > TOP:
                far = f >= np.partition(f, len(f) - TOP)[len(f) - TOP]
                rows, f = rows[far], f[far]
            self.top[g] = sorted([*self.top[g], *((-int(v), terms[i]) for v, i in zip(f, rows, strict=True))])[:TOP]

    def found(self, lang: str) -> Iterator[dict]:
        left, right = self.names
        for i, g in enumerate(left):
            for j in np.flatnonzero(self.sum[i]).tolist():
                if g != right[j]:
                    yield {"part": "pair", "lang": lang, "source": g, "item": right[j], "value": int(self.sum[i, j])}
                    if not self.same:
                        yield {"part": "pair", "lang": lang, "source": right[j], "item": g, "value": int(self.sum[i, j])}
            for v, term in self.top[i]:
                yield {"part": "term", "lang": lang, "source": g, "item": term, "value": -v}


def _correct(groups: dict[str, tuple]):
    """``groups``: lang -> (left groups, right groups or None, occurrences of the language, its kept terms)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = {lang: _Language(*g) for lang, g in groups.items()}
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), object)
            for lang in sorted(set(langs)):
                rows = batch.take(pa.array(np.flatnonzero(langs == lang)))
                names = rows.column("names")
                of = np.repeat(np.arange(rows.num_rows), pc.list_value_length(names).to_numpy())
                state[lang].add(rows.column("term").to_pylist(), of, names.flatten(),
                                rows.column("counts").flatten().to_numpy())
        for lang, s in state.items():
            yield from _batches(s.found(lang), _ARROW_FOUND, 10_000)

    return run


def _passes(stats: DataFrame, at_once: int) -> Iterator[tuple[str | None, dict[str, tuple]]]:
    """(language or None for all, groups) of each pass of corrections; what one pass carries is bounded by ``at_once`` groups a side."""
    def read(rows: DataFrame) -> dict[str, tuple]:
        out: dict[str, tuple] = {}
        for r in rows.collect():
            out.setdefault(r["lang"], ([], None, r["total"], r["kept"]))[0].append((r["source"], r["n"]))
        return out

    live = stats.where("kept > 0")
    if live.count() <= at_once:
        yield None, read(live)
        return
    for row in live.groupBy("lang").agg(F.max("block").alias("last")).toLocalIterator():
        lang, mine = row["lang"], live.where(F.col("lang") == row["lang"])
        for a in range(row["last"] + 1):
            left = read(mine.where(F.col("block") == a))
            yield lang, left
            for b in range(a + 1, row["last"] + 1):
                right = read(mine.where(F.col("block") == b))
                yield lang, {lang: (left[lang][0], right[lang][0], *left[lang][2:])}


def source_divergence(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", min_docs: int = MIN_DOCS,
                      at_once: int = GROUPS_AT_ONCE) -> DataFrame:
    """(lang, source, part, item, value, rank) of every source of every language.

    ``part`` pair: each other source of the language with the distance over all kept terms,
    all ranks. ``part`` term: the TOP kept terms that the source uses beyond its language.
    Ranks are by value descending, then item ascending in UTF-8.

    Null lang, source and text are empty texts. A source without terms is a group all the
    same; a language without kept terms has pairs of value 0; a language of one source has no
    pairs. Equal rows count as documents each. A very long text is one piece of work, split
    into terms by pieces. An empty table gives no rows. Other columns are ignored.
    """
    spark, at = docs.sparkSession, stage_dir(docs.sparkSession)
    d = docs.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(n) for c, n in
                      ((lang, "lang"), (source, "source"), (text, "text"))])
    groups = stage(d.groupBy("lang", "source").agg(F.sum(F.octet_length("text").cast("long")).alias("bytes")), f"{at}/groups")
    size = groups.agg(F.sum("bytes")).first()[0] or 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // SHARD_BYTES))
    freq = stage(frequencies(d, shards, min_docs), f"{at}/frequencies")

    each = freq.select("lang", F.explode(F.arrays_zip("names", "counts")).alias("x")) \
        .groupBy("lang", F.col("x.names").alias("source")).agg(F.sum("x.counts").alias("n"))
    kept = freq.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"))
    total = each.groupBy("lang").agg(F.sum("n").alias("total"))
    stats = groups.select("lang", "source").join(each, ["lang", "source"], "left").join(total, "lang", "left").join(kept, "lang", "left")
    stats = stats.na.fill(0, ["n", "total", "kept"])
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    stats = stage(stats.withColumn("block", F.floor(number / F.lit(at_once)).cast("int")), f"{at}/groups-of-language")

    found = None
    for one, carried in _passes(stats, at_once):
        rows = (freq if one is None else freq.where(F.col("lang") == one)).mapInArrow(_correct(carried), _FOUND)
        found = rows if found is None else found.union(rows)
    if found is None:
        found = spark.createDataFrame([], _FOUND)
    found = stage(found, f"{at}/found")

    # every pair of a language's sources starts from what a term that neither uses adds; blocks of items keep a language in many tasks
    last = stats.groupBy("lang").agg(F.max("block").alias("last"))
    a = stats.join(last, "lang").select("lang", "source", "kept", "n", F.explode(F.sequence(F.lit(0), "last")).alias("block"))
    b = stats.select("lang", "block", F.col("source").alias("item"), F.col("n").alias("m"))
    zero = lambda n: F.expr(f"1 + {2 * SCALE} div ({n} + 2 * kept)")
    p, q = zero("n"), zero("m")
    pairs = a.join(b, ["lang", "block"]).where(F.col("source") != F.col("item"))
    pairs = pairs.withColumns({"p": F.when(F.col("kept") > 0, p), "q": F.when(F.col("kept") > 0, q)})
    start = F.coalesce(F.expr("kept * (((p - q) * (p - q)) div (p + q))"), F.lit(0))
    change = found.where("part = 'pair'").groupBy("lang", "source", "item").agg(F.sum("value").alias("change"))
    pairs = pairs.join(change, ["lang", "source", "item"], "left") \
        .select("lang", "source", F.lit("pair").alias("part"), "item", (start + F.coalesce("change", F.lit(0))).alias("value"))
    terms = found.where("part = 'term'").select("lang", "source", "part", "item", "value")
    place = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), "item"))
    return pairs.union(terms).withColumn("rank", place).where((F.col("part") == "pair") | (F.col("rank") <= TOP))
