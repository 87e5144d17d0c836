import random

from pyspark.sql import functions as F

from riskspark.llm.line_dedup import host_of, line_dedup, page_text


def test_matches_brute_force(spark):
    rng = random.Random(5)
    rows = []
    for i in range(160):
        host = rng.choice(["a.com", "a.com", "b.org", None])
        lines = [f"unique {i} {j}" for j in range(rng.randint(0, 5))]
        for footer, p in (("footer", .6), ("  menu\t", .3), ("rare", .05), ("", .5)):
            if rng.random() < p:
                lines.insert(rng.randint(0, len(lines)), footer)
        rows.append((i, host, None if i % 40 == 7 else "\n".join(lines)))
    rows += [(200, "a.com", "footer\nfooter"), (200, "a.com", "footer\nfooter"), (None, "a.com", "menu"), (201, "c.net", "footer")]
    df = spark.createDataFrame(rows, "doc_id long, host string, text string")
    got = line_dedup(df, F.col("host"), F.col("text"), ratio=.25, min_pages=5).select("row.doc_id", "row.host", "text", "n_lines", "n_removed")
    total, seen = {}, {}
    for _, h, t in rows:
        total[h] = total.get(h, 0) + 1
        for x in {y.strip() for y in (t or "").split("\n")} - {""}:
            seen[h, x] = seen.get((h, x), 0) + 1
    want = []
    for d, h, t in rows:
        bad = [y for y in (t or "").split("\n") if seen.get((h, y.strip()), 0) >= 5 and seen[h, y.strip()] > .25 * total[h]]
        kept = t if t is None else "\n".join(y for y in t.split("\n") if y not in bad)
        want.append((d, h, kept, 0 if t is None else sum(1 for y in t.split("\n") if y.strip()), len(bad)))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert any(w[4] for w in want)
    assert line_dedup(df.limit(0), F.col("host"), F.col("text")).collect() == []


def test_page_text(spark):
    html = '<html><script>a\n</script><nav><ul><li><a href="/x">X</a></li></ul></nav><!-- c --><p>One &amp; two<br>three</p></html>'
    r = spark.createDataFrame([(html, "https://U@Blog.Example.com:80/a?b"), (None, "mailto:x")], "html string, url string") \
        .select(page_text(F.col("html")).alias("t"), host_of(F.col("url")).alias("h")).collect()
    assert [x for x in r[0]["t"].split("\n") if x.strip()] == ["X", "One & two", "three"] and r[0]["h"] == "blog.example.com"
    assert r[1]["t"] is None and r[1]["h"] is None


def test_the_ratio_decides_on_small_and_large_hosts(spark):
    """Hosts of 3, 10 and 50 pages: lines on one page stay, lines above the ratio on two or more go, lines at the ratio stay."""
    rows = []
    for host, pages in (("three", 3), ("ten", 10), ("fifty", 50)):
        for i in range(pages):
            lines = [f"own {host} {i}"] + ["on two"] * (i < 2) + ["tenth"] * (i < pages // 10) + ["over"] * (i < pages // 10 + 1)
            rows.append((host, i, "\n".join(lines)))
    df = spark.createDataFrame(rows, "host string, i long, text string")
    got = {(r["row"]["host"], r["row"]["i"]): r["text"].split("\n") for r in line_dedup(df, F.col("host"), F.col("text")).collect()}
    left = {h: {x for (k, _), v in got.items() if k == h for x in v if not x.startswith("own")} for h in ("three", "ten", "fifty")}
    assert left == {"three": {"over"}, "ten": {"tenth"}, "fifty": {"on two", "tenth"}}
    assert all(f"own {h} {i}" in v for (h, i), v in got.items())
