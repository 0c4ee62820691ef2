"""Recurring line templates on small documents."""

from gridvoice.llm import templates

DOCS = "doc_id long, text string, lang string, source string, n_chars long, line string, leaf long, keeper long"


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "en", "s", len(t or ""), "l", 1, 2) for d, t in rows], DOCS)


def left(df):
    return {r["doc_id"]: r["text_left"] for r in df.collect()}


def test_variable_fields_are_generalised(few):
    names = ["anna", "bert", "carl", "dora", "emil"]
    rows = [(n, f"{'abcde'[n] * 3} alone\nThe user called {who} logged in at port {n} with no error today") for n, who in enumerate(names)]
    got = left(templates.dedup(frame(few, rows), templates.Settings(min_docs=5)))
    assert got == {n: t if n == 0 else t.split("\n")[0] for n, t in rows}


def test_prose_with_a_common_beginning_stays(few):
    rows = [(n, f"it was the {'abcdef'[n]}{n} best{n}x of{n}y times{n}z ever{n}w seen{n}v") for n in range(6)]
    rows = [(n, t.translate(str.maketrans("0123456789", "qrstuvwxyz"))) for n, t in rows]
    assert left(templates.dedup(frame(few, rows))) == dict(rows)


def test_few_documents_do_not_recur(few):
    rows = [(n, f"shared line of four\n{'abcd'[n] * 3} own") for n in range(4)]
    assert left(templates.dedup(frame(few, rows))) == dict(rows)


def test_odd_rows(few):
    line = "the very same line"
    rows = [(n, line) for n in range(5)] + [(9, f"{line}\n\n{line}\nrest"), (10, None), (11, ""), (12, " \n"), (None, line), (2, line)]
    got = templates.dedup(frame(few, rows)).collect()
    assert sorted(((r["doc_id"], r["n_lines"], r["n_dropped"], r["text_left"]) for r in got), key=repr) == sorted(
        [(0, 1, 0, line), *[(n, 1, 1, "") for n in (1, 2, 2, 3, 4, None)], (9, 4, 2, "\nrest"), (10, 0, 0, None), (11, 1, 0, ""), (12, 2, 0, " \n")],
        key=repr,
    )
    df = frame(few, rows)
    cut = templates.without_recurring(df)
    assert cut.columns == df.columns
    assert {r["doc_id"]: (r["text"], r["n_chars"]) for r in cut.collect()} == {0: (line, 18), 9: ("\nrest", 5), 10: (None, 0), 11: ("", 0), 12: (" \n", 2)}


def test_empty_table(few):
    assert templates.dedup(frame(few, [])).count() == 0
    assert templates.without_recurring(frame(few, [])).count() == 0


def test_identical_long_lines_recur_from_two_documents_on(few):
    import corpus_pipeline

    long = " ".join(f"{'abcde'[n % 5]}{'xyz'[n % 3]}{'kl' * (n // 9)}" for n in range(50))
    short, near = long.rsplit(" ", 1)[0], long.replace("ax", "bx", 1)
    rows = [(4, f"own\n{long}"), (2, f"{long}\nalso own"), (7, long), (5, short), (6, short), (8, f"{near}\n{long} 1"), (9, f"{long} 2"), (None, f"z\n{long}")]
    got = {r["doc_id"]: r["text"] for r in corpus_pipeline.lines(few, frame(few, rows), "").collect()}
    assert got == {4: "own", 2: f"{long}\nalso own", 5: short, 6: short, 8: f"{near}\n{long} 1", 9: f"{long} 2", None: "z"}
    assert left(templates.dedup(frame(few, rows))) == dict(rows)


def variants(doc, names, ending="delta eps zeta eta theta iota kappa"):
    return (doc, "\n".join(f"alpha beta gamma {name} {ending}" for name in names))


def test_lines_of_one_document_count_once(few):
    """Two documents with three lines of a template each, and three that only share its beginning."""
    rows = [variants(1, ["anna", "bert", "carl"]), variants(2, ["dora", "emil", "fred"])]
    rows += [(n, f"alpha beta gamma {'xyz'[n - 3] * 2} {'uvw'[n - 3]}a b{n}c d{'klm'[n - 3]} e{'fgh'[n - 3]} f g") for n in (3, 4, 5)]
    assert left(templates.dedup(frame(few, rows))) == dict(rows)


def test_documents_are_listed_where_first_documents_do_not_tell(few):
    """Every line stands in document 1 and in one other: one first document, but six documents."""
    names = ["anna", "bert", "carl", "dora", "emil"]
    rows = [variants(1, names)] + [variants(2 + n, [name]) for n, name in enumerate(names)]
    got = left(templates.dedup(frame(few, rows)))
    assert got == {1: rows[0][1], **{n: "" for n in range(2, 7)}}
    # with one of them less there are five, with two less four
    assert left(templates.dedup(frame(few, rows[:5]))) == {1: rows[0][1], **{n: "" for n in range(2, 6)}}
    assert left(templates.dedup(frame(few, rows[:4]))) == dict(rows[:4])


def test_clashing_names_and_very_long_lines(few):
    import pyspark.sql.functions as F

    line, long = "the very same line of text", " ".join(f"w{'abcdefghij'[n % 10]}" for n in range(40_000))
    rows = [(n, f"{line}\n{long}\n{'abcde'[n]}{'vwxyz'[n]} own") for n in range(5)]
    names = ["_id", "_hash", "_dropped", "dropped", "own_id", "OWN_HASH", "text_hash", "exact"]
    df = frame(few, rows).withColumns({c: F.concat(F.lit(c), F.col("doc_id")) for c in names})
    cut = templates.without_recurring(df)
    assert cut.columns == df.columns
    for r in cut.collect():
        assert r["text"] == (rows[0][1] if r["doc_id"] == 0 else rows[r["doc_id"]][1].rsplit("\n", 1)[1])
        assert all(r[c] == f"{c}{r['doc_id']}" for c in names)
