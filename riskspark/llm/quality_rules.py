"""Line-first quality rules (numbered operator 4), in DataFrame functions only.

Every line is judged by itself first: lines of symbols, navigation lines and boilerplate
lines fail and are removed. A document is rejected when the base measures fail, or when what
the rules removed is too large a share of its words, or too little remains.

Everything is row-local: one pass over the table, no shuffle, so no key can be hot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.llm.common import WORD, let, words

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
#: A document is rejected when more than this percentage of its words were in failed lines.
MAX_LOST_PERCENT = 50

SYMBOLS = r"[#*$%&|<>]"
#: A line fails with more than so many symbols per 100 words,
MAX_SYMBOLS_PER_100 = 20
#: or with more than so many of its words shouted (ending in two exclamation marks, or more), in percent.
MAX_SHOUT_PERCENT = 50
#: Short menu lines: words or phrases between separators.
NAVIGATION = r"(?i)^\s*(?:home|menu|login|log in|sign in|sign up|next|previous|back to top|contact|about us|search|share)(?:\s*[|>»·/-]\s*\S.*)?\s*$"
BOILERPLATE = r"(?i)(?:cookie policy|terms of (?:use|service)|privacy policy|subscribe to our|javascript is (?:disabled|required)|lorem ipsum)"
SHOUT = r"!!+(?:[\x20\x09-\x0D]|$)"
#: Navigation and boilerplate rules are for lines of at most so many words.
SHORT_LINE = 30


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


def judge_line(line: Column) -> Column:
    """Struct (n, fails): words of one line, and whether a rule fails it; a line without words passes."""
    facts = F.struct(_count(line, WORD).alias("n"), _count(line, SYMBOLS).alias("symbols"), _count(line, SHOUT).alias("shouts"))

    def rules(m: Column) -> Column:
        punctuation = (m["symbols"] * 100 > m["n"] * MAX_SYMBOLS_PER_100) | (m["shouts"] * 100 > m["n"] * MAX_SHOUT_PERCENT)
        short = (m["n"] <= SHORT_LINE) & (F.rlike(line, F.lit(NAVIGATION)) | F.rlike(line, F.lit(BOILERPLATE)))
        return F.struct(m["n"].alias("n"), ((m["n"] > 0) & (punctuation | short)).alias("fails"))

    return let(facts, rules)


def repeat_words(ws: Column) -> Column:
    """Words covered by 8-word windows found twice or more in the array of words (first ones included)."""

    def covered(windows: Column) -> Column:
        by_hash = F.array_sort(F.transform(windows, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        twice = let(by_hash, lambda s: F.filter(F.transform(s, lambda x, k: F.when(
            (x["h"] == F.get(s, k - 1)["h"]) | (x["h"] == F.get(s, k + 1)["h"]), x["i"])), lambda i: i.isNotNull()))
        return F.aggregate(F.array_sort(twice), F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("sum")),
                           lambda a, i: F.struct(i.alias("last"), (a["sum"] + F.least(F.lit(WINDOW), i - a["last"])).alias("sum")),
                           lambda a: a["sum"])

    def of_windows(h: Column) -> Column:
        windows = F.transform(F.sequence(F.lit(0), F.size(h) - WINDOW), lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(WINDOW)]))
        # a document without two equal windows is settled by a hash set; only others are sorted
        return let(windows, lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0).cast("long")).otherwise(covered(w)))

    return F.when(F.size(ws) <= WINDOW, F.lit(0).cast("long")).otherwise(let(F.transform(ws, lambda w: F.xxhash64(w)), of_windows))


def quality_rules(docs: DataFrame, text: Column) -> DataFrame:
    """(row, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lost_words, base_failed, kept, clean_text) of every row.

    Words are runs of anything but ASCII white space. ``base_failed``: fewer than 20 words, or
    over 30 % of the words in 8-word windows that the text holds twice. ``n_lost_words`` counts
    words in failed lines, ``clean_text`` is the text without those lines, and ``kept`` is false
    for a failed base or when over MAX_LOST_PERCENT of the words are lost or fewer than 20 remain.

    Null and empty texts have no words and fail; a very long line is one line; equal rows come
    back each; an empty table gives no rows. Input columns come back inside ``row``.
    """
    t = F.coalesce(text, F.lit(""))
    base = docs.select(F.struct("*").alias("row"), t.alias("text"))
    lines = F.split("text", "\n")
    base = base.withColumn("lines", F.transform(lines, lambda x: F.struct(x.alias("line"), judge_line(x).alias("j"))))
    worded = F.transform(F.filter("lines", lambda x: x["j"]["n"] > 0), lambda x: x["line"])
    add = lambda pick: F.aggregate("lines", F.lit(0).cast("long"), lambda a, x: a + pick(x))
    out = base.select(
        "row",
        add(lambda x: x["j"]["n"]).alias("n_words"),
        F.length(F.regexp_replace("text", r"[\x20\x09-\x0D]+", "")).cast("long").alias("word_chars"),
        _count(F.col("text"), SYMBOLS).cast("long").alias("n_symbols"),
        let(worded, lambda w: F.size(w) - F.size(F.array_distinct(w))).cast("long").alias("n_dup_lines"),
        repeat_words(words(F.col("text"))).alias("n_repeat_words"),
        add(lambda x: F.when(x["j"]["fails"], x["j"]["n"]).otherwise(F.lit(0))).alias("n_lost_words"),
        F.array_join(F.transform(F.filter("lines", lambda x: ~x["j"]["fails"]), lambda x: x["line"]), "\n").alias("clean_text"))
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)
    out = out.withColumn("base_failed", failed)
    lost = (F.col("n_lost_words") * 100 > F.col("n_words") * MAX_LOST_PERCENT) | (F.col("n_words") - F.col("n_lost_words") < MIN_WORDS)
    return out.withColumn("kept", ~F.col("base_failed") & ~lost)
