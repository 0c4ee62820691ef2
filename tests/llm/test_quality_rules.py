"""Counts against brute force, and the cascade."""

import random
import re
from collections import Counter

from pyspark.sql import functions as F

from gridvoice.llm import rules

DOCS = "doc_id long, text string, n_words string, kept string, _words long"


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(8)}
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(covered),
    )


def test_counts(few):
    rng = random.Random(1)
    texts = [None, "", " \n\t", "one", "😀 é#|", "a " * 3000, "x\n\n x\nx\n\x0bx\n"]
    for _ in range(60):
        size = rng.randrange(60)
        texts.append(rng.choice([" ", "\n", "\t "]).join(rng.choice("ab") + rng.choice("#c") for _ in range(size)))
    texts += ["w1 w2 w3 w4 w5 w6 w7 w8 w9 " * 3 + "end"]
    df = few.createDataFrame([(n, t, "a", "b", 3) for n, t in enumerate(texts)] + [(None, "q", "", "", 0), (1, "z z", "", "", 0)], DOCS)
    got = rules.judge(df).collect()
    assert len(got) == len(texts) + 2
    for row in got:
        if row["doc_id"] is not None and not (row["doc_id"] == 1 and row["n_words"]):
            n = brute(texts[row["doc_id"]])
            assert tuple(row)[1:6] == n
            assert row["base_failed"] == (n[0] < 20 or 100 * n[4] > 30 * n[0])
            assert not (row["base_failed"] and row["kept"])


def test_order_has_no_effect_and_nulls_do_not_reject(few):
    df = few.range(20).withColumn("v", F.when(F.col("id") % 3 > 0, F.col("id")))
    conditions = {"a": F.col("v") > 15, "b": F.col("v") % 2 == 0, "c": F.lit(None).cast("boolean")}
    results = [
        [r[0] for r in df.select(rules.cascade(conditions, order)).collect()] for order in (["a", "b", "c"], ["c", "b", "a"])
    ]
    assert results[0] == results[1]
    assert results[0][:4] == [True, True, False, True]
    assert sorted(rules.order_of(df, conditions)) == ["a", "b", "c"]


def test_order_follows_what_the_rules_before_leave(few):
    """Rule b rejects most, a rejects only rows that b rejects, c few others; d is dear and rejects as many as b."""
    df = few.range(100).withColumnRenamed("id", "v")
    v = F.col("v")
    conditions = {"a": v < 40, "b": v < 50, "c": (v >= 50) & (v < 55), "d": v >= 50, "n": F.lit(None).cast("boolean")}
    cheap = dict.fromkeys(conditions, 1.0)
    assert rules.order_of(df, conditions, cost=cheap | {"d": 20.0}) == ["b", "c", "d", "a", "n"]
    assert rules.order_of(df, conditions, cost=cheap) == ["b", "d", "a", "c", "n"]
    # what the base rejects counts for no rule
    assert rules.order_of(df, conditions, v < 50, cheap)[0] == "d"


def test_costs_that_cannot_be_told_apart_are_equal():
    first = rules.in_classes({"a": 0.001, "b": -0.01, "c": 0.03, "x": 1.0, "y": 1.7, "z": 2.9, "w": 7.0})
    assert first["a"] == first["b"] == first["c"] < first["x"]
    again = rules.in_classes({"a": 0.02, "b": 0.004, "c": -0.02, "x": 1.4, "y": 1.2, "z": 2.2, "w": 7.0})
    assert again["a"] == again["b"] == again["c"]
    assert again["x"] == again["y"] == again["z"] < again["w"]
    assert rules.in_classes({}) == {}


def test_one_order_in_repeated_runs(few):
    from gridvoice.llm.common import kept, table

    sample = kept(rules.counts(table(few, "/root/testdata/sf0.01", "documents").select("text")), "sample")
    orders = {tuple(rules.order_of(sample, rules.standard(), rules.base_failed())) for _ in range(4)}
    assert len(orders) == 1
    cost = rules.costs(sample, rules.standard())
    assert cost["symbols"] < cost["capitals"] and cost["short words"] < cost["cut lines"]


def test_a_dear_rule_is_not_evaluated_on_rejected_rows(few):
    df = few.range(50).withColumnRenamed("id", "v")
    fails = F.raise_error(F.lit("evaluated")).cast("boolean")
    got = df.select(rules.cascade({"dear": fails}, ["dear"], F.col("v") >= 0).alias("k")).collect()
    assert not any(r["k"] for r in got)


def test_clean_text_is_kept_and_junk_is_not(few):
    prose = "The quick brown foxes jump over some lazy dogs while many other animals watch them from the green hill today, quietly."
    junk = [prose.upper(), prose.replace(" ", " | # "), "\n".join("- " + w for w in prose.split() + prose.split("o")), "..." * 30]
    df = few.createDataFrame([(n, t, "", "", 0) for n, t in enumerate([prose, *junk])], DOCS)
    assert {r["doc_id"]: r["kept"] for r in rules.judge(df).collect()} == {0: True, 1: False, 2: False, 3: False, 4: False}
    assert rules.judge(df.limit(0)).count() == 0
