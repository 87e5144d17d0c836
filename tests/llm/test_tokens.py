import hashlib
import random
import zlib

import numpy as np

from riskspark.llm import bpe_chunks, token_files
from riskspark.llm.bpe_chunks import encode_digests, encode_texts
from riskspark.llm.token_files import pack, read_token_files, unpack, write_token_files
from riskspark.llm.tokens import load, vocabulary

BYTE, WORDS = vocabulary("byte_bpe_50k.json"), vocabulary("word_bpe_49k.json")


def texts():
    rng = random.Random(9)
    vocab = ["the", "of", "Thsh", "éaiai", "ß", "don't", "x1y22", "...", "日本語", "a b", "<|endoftext|>", "I'll", "\U0001f600", "é", "ΣΑΣ"]
    gaps = [" "] * 12 + ["  ", "\n", "\n\n", " \t", "　", "  ", "", "\x1c ", "\u0085"]
    passage = "".join(rng.choice(vocab) + " " for _ in range(900))
    out = [None, "", " ", "\n", " a", "a ", "<|endoftext|>", "日本語" * 4000, "x" * 30000, "ab cd " * 5000, " " * 9000, "é\n" * 4000, "1 . " * 4000]
    for _ in range(40):
        t = "".join(rng.choice(vocab) + rng.choice(gaps) for _ in range(rng.randint(1, 900)))
        out.append(t if rng.random() < .5 else t + passage + t[::-1])
    return out


def test_encodes_and_decodes_as_the_library(spark, monkeypatch):
    rows = [(i, t, 5) for i, t in enumerate(texts())] + [(3, "twice", 1), (3, "twice", 1), (None, "no id", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, batch int")
    tok = load(BYTE)
    want = []
    for d, t, _ in rows:
        ids = tok.encode(t or "", add_special_tokens=False).ids
        dec = tok.decode(ids, skip_special_tokens=False)
        want.append((d, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(dec.encode()).hexdigest()))
    got = sorted(map(tuple, encode_digests(df, BYTE).collect()), key=str)
    bad = {w[0] for w in want} & {g[0] for g in set(got) ^ set(want)}
    assert not bad, sorted(bad, key=str)
    assert got == sorted(want, key=str)
    full = encode_texts(df.where("doc_id = 20"), BYTE).first()
    assert full["decoded"] == rows[20][1]
    assert encode_digests(df.limit(0), BYTE).collect() == []


def test_cuts_need_no_neighbours():
    passage = " ".join(f"word{i * i % 9973} of" for i in range(3000)).encode()
    a, b = b"some other start. " + passage, b"Q" * 777 + b" " + passage + b" tail"

    def tails(t):
        d = np.frombuffer(t, np.uint8)
        s, safe = bpe_chunks.cut_points(d, np.array([0, len(d)]))
        return {t[x:y] for x, y in zip(s, np.append(s[1:], len(d)))}
    assert len(tails(a) & tails(b)) > 0.8 * len(tails(a)) > 5


def test_blocks_round_trip():
    rng = np.random.RandomState(0)
    for ids in (np.zeros(0, np.uint32), np.array([7], np.uint32), np.full(1000, 2**32 - 1, np.uint32), rng.randint(0, 2**32, 5000, dtype=np.int64).astype(np.uint32),
                rng.randint(0, 49408, 70001).astype(np.uint32), np.where(rng.rand(9000) < .03, 4_000_000_000, rng.randint(0, 30, 9000)).astype(np.uint32)):
        p = pack(ids)
        assert np.array_equal(unpack(p), ids)
        assert np.array_equal(unpack(p, 2, 5), ids[2 * token_files.BLOCK: 5 * token_files.BLOCK])


def test_files_hold_the_librarys_ids(spark, tmp_path):
    rows = [(100 - i, t, "x") for i, t in enumerate(texts())] + [(None, "no id", None), (7, None, None), (500, "last", "")]
    df = spark.createDataFrame(rows, "doc_id long, text string, payload string").repartition(5)
    write_token_files(df, str(tmp_path / "t"), WORDS)
    tok, start, want = load(WORDS), 0, []
    for d, t, _ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = tok.encode(t or "", add_special_tokens=False).ids + [2]
        want.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, read_token_files(spark, str(tmp_path / "t")).collect()), key=str) == sorted(want, key=str)
    write_token_files(df.limit(0), str(tmp_path / "e"), WORDS)
    assert read_token_files(spark, str(tmp_path / "e")).collect() == []


def test_id_lists_round_trip():
    rng = np.random.RandomState(3)
    for ids in (np.zeros(0, np.int64), np.array([5, 5]), rng.randint(0, 50257, 9000), (rng.pareto(.6, 20000) * 9).astype(np.int64) % 50257,
                rng.randint(0, 200, 500), rng.permutation(100_000), np.repeat(np.arange(3000), 2)):
        assert np.array_equal(bpe_chunks.unpack_ids(bpe_chunks.pack_ids(ids)), ids)
