"""Quality rules as a short-circuit cascade. Only DataFrame functions.

The counts of a text, which are part of the result, are taken once for every text. The rules are then tried one after the other until
one rejects; each of them does its own work on the text (letters, endings and beginnings of lines) only if none before it rejected. Their order
is by rejections per cost among the rows that are left, both measured on a sample. The order has no effect on the verdict.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridvoice.llm.common import kept

WHITE = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[^#*$%&|<>]+"
WINDOW = 8
#: Rows of the sample on which cost and selectivity are measured; it decides on speed only.
SAMPLE_ROWS = 2000
#: Times that a job reads the sample, and jobs per rule, to measure its cost.
COPIES = 4
ROUNDS = 3


def _count(c: Column) -> Column:
    return F.coalesce(c, F.lit(0)).cast("long")


def counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds ``n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words`` to the rows.

    A word is a run of characters other than ASCII white space. ``n_repeat_words`` counts the words inside windows of eight
    words that occur twice or more in the text.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    own = docs.columns
    split = docs.withColumn("_words", F.array_remove(F.split(text, WHITE), "")).withColumn(
        "_lines", F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    )
    sized = split.withColumn("n_words", F.size("_words"))
    windows = F.transform(
        F.sequence(F.lit(1), F.col("n_words") - (WINDOW - 1)), lambda i: F.xxhash64(F.slice("_words", i, WINDOW))
    )
    hashed = sized.withColumn("_hashes", F.when(F.col("n_words") >= WINDOW, windows)).withColumn(
        "_again", F.size(F.array_distinct("_hashes")) < F.size("_hashes")
    )
    # only texts that repeat a window pay for the order of their windows
    ordered = F.array_sort(F.transform("_hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    sorted_ = hashed.withColumn("_sorted", F.when(F.col("_again"), ordered))
    equals_neighbour = lambda e, j: (
        F.coalesce(F.get("_sorted", j - 1)["h"] == e["h"], F.lit(False))
        | F.coalesce(F.get("_sorted", j + 1)["h"] == e["h"], F.lit(False))
    )
    repeated = F.array_sort(
        F.transform(F.filter("_sorted", equals_neighbour), lambda e: e["i"])
    )
    covered = F.aggregate(
        "_repeated",
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("upto")),
        lambda a, i: F.struct(
            (a["n"] + i + WINDOW - F.greatest(i, a["upto"])).alias("n"), (i + WINDOW).alias("upto")
        ),
        lambda a: a["n"],
    )
    return (
        sorted_.withColumn("_repeated", repeated)
        .withColumn("n_repeat_words", _count(covered))
        .select(
            *own,
            F.col("n_words").cast("long").alias("n_words"),
            _count(F.length(F.array_join("_words", ""))).alias("word_chars"),
            _count(F.length(F.regexp_replace(text, SYMBOLS, ""))).alias("n_symbols"),
            _count(F.size("_lines")).alias("n_lines"),
            (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
            "n_repeat_words",
        )
    )


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30)


def standard(text_col: str = "text") -> dict[str, Column]:
    """The rules beyond the base: true rejects. They need the columns of ``counts`` and the text."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    without_letters = F.length(F.regexp_replace(text, r"[\x20\x09-\x0D\p{L}]+", ""))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    trailing = F.size(F.filter(lines, lambda line: line.rlike(r"(\.\.\.|…)[\x20\x09-\x0D]*$")))
    bullets = F.size(F.filter(lines, lambda line: line.rlike(r"^[\x20\x09-\x0D]*[-*•]")))
    return {
        "short words": F.col("word_chars") < F.col("n_words") * 2,
        "long words": F.col("word_chars") > F.col("n_words") * 15,
        "symbols": F.col("n_symbols") * 10 > F.col("n_words"),
        "duplicate lines": F.col("n_dup_lines") * 10 > F.col("n_lines") * 3,
        "capitals": capitals * 2 > F.col("word_chars"),
        "no letters": without_letters * 2 > F.col("word_chars"),
        "cut lines": trailing * 10 > F.col("n_lines") * 3,
        "bullet lines": bullets * 10 > F.col("n_lines") * 9,
    }


def costs(sample: DataFrame, rules: dict[str, Column], copies: int = COPIES, rounds: int = ROUNDS) -> dict[str, float]:
    """Seconds that a rule takes on the copied sample; rules whose costs cannot be told apart have the same.

    The sample is read ``copies`` times in a job, so that the rule and not the job is measured; the least of some rounds counts. What
    is below a sixteenth of the dearest rule is taken as that, and rules that follow each other within a factor of two
    form a class and cost its mean: a measure in a busy session is not more exact, and the order shall not depend on it.
    """
    many = sample.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))

    def seconds(condition: Column) -> float:
        began = time.perf_counter()
        many.agg(F.sum(condition.cast("int"))).collect()
        return time.perf_counter() - began

    idle, took = float("inf"), dict.fromkeys(rules, float("inf"))
    for _ in range(rounds):
        idle = min(idle, seconds(F.col("_copy") < 0))
        for name, condition in rules.items():
            took[name] = min(took[name], seconds(condition))
    return in_classes({name: t - idle for name, t in took.items()})


def in_classes(cost: dict[str, float]) -> dict[str, float]:
    """Each cost as the mean of its class: costs of at least a sixteenth of the largest, a factor of two apart at most."""
    least = max(max(cost.values(), default=0) / 16, 1e-3)
    classes: list[list[str]] = []
    for name in sorted(cost, key=lambda n: (cost[n], n)):
        before = max(cost[classes[-1][-1]], least) if classes else None
        if before is None or max(cost[name], least) > 2 * before:
            classes.append([])
        classes[-1].append(name)
    return {name: sum(max(cost[n], least) for n in c) / len(c) for c in classes for name in c}


def order_of(
    sample: DataFrame, rules: dict[str, Column], first: Column | None = None, cost: dict[str, float] | None = None
) -> list[str]:
    """Names of the rules: at each place the one with most rejections per cost of the rows that the rules before it leave.

    Rows that ``first`` rejects reach no rule. Rejections come from one pass: rows per set of rules that reject them, at most one
    set per row of the sample. Ties go by name.
    """
    cost = costs(sample, rules) if cost is None else cost
    verdicts = [F.coalesce(condition, F.lit(False)).alias(f"v{k}") for k, condition in enumerate(rules.values())]
    reaching = sample if first is None else sample.filter(~F.coalesce(first, F.lit(False)))
    sets = [
        ({name for name, rejects in zip(rules, r) if rejects}, r["count"])
        for r in reaching.select(*verdicts).groupBy(*[f"v{k}" for k in range(len(rules))]).count().collect()
    ]
    order: list[str] = []
    while len(order) < len(rules):
        sets = [(who, n) for who, n in sets if not who & set(order)]
        gain = {name: sum(n for who, n in sets if name in who) / cost[name] for name in rules if name not in order}
        # rules that reject nothing more: cheap ones first
        order.append(min(gain, key=lambda name: (-gain[name], cost[name], name)))
    return order


def cascade(rules: dict[str, Column], order: list[str], first: Column | None = None) -> Column:
    """True if no rule rejects; a rule is evaluated only if those before it did not reject."""
    chain = F.when(first, F.lit(False)) if first is not None else F.when(F.lit(False), F.lit(False))
    for name in order:
        chain = chain.when(F.coalesce(rules[name], F.lit(False)), F.lit(False))
    return chain.otherwise(F.lit(True))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Per row: ``doc_id``, the counts, ``base_failed`` and ``kept``.

    Null and empty texts have no words, so the base rejects them. Rows that repeat an id, or have a null one, are each judged
    on their own text. Texts of any length are judged whole. Rules with equal rejections per cost are tried by name, without effect on the verdict.
    Other columns, whatever their names, are ignored. An empty table gives an empty table.
    """
    plain = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = plain.count()
    sample = kept(counts(plain.sample(min(1.0, sample_rows / max(rows, 1)), seed=5)), "sample")
    rules = standard()
    verdict = cascade(rules, order_of(sample, rules, base_failed()), base_failed())
    return counts(plain).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base_failed().alias("base_failed"),
        verdict.alias("kept"),
    )
