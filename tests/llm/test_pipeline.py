"""The registered queries against their SQL twins, and the pipeline's stages against each other."""

from collections import defaultdict

import corpus_pipeline
import crosscheck
import pytest

from gridvoice.llm import queries
from gridvoice.llm.common import kept, table

DIRECTORY = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(queries.SQL))
def test_matches_sql(few, name):
    duck = crosscheck.duck(DIRECTORY)
    ok, _, _, note = crosscheck.compare(few, duck, name, queries.QUERIES[name], queries.SQL[name], DIRECTORY)
    assert ok, note


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


def test_stages(few):
    docs = table(few, DIRECTORY, "documents")
    columns, before = docs.columns, {r["doc_id"] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = kept(stage(few, docs, DIRECTORY), name)
        assert docs.columns == columns
        now = {r["doc_id"] for r in docs.collect()}
        assert now <= before and now
        before = now
    placed = corpus_pipeline.STAGES[-1][1](few, docs, DIRECTORY).collect()
    assert {r["doc_id"] for r in placed} == before
    by_sequence = defaultdict(list)
    for r in placed:
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in by_sequence.values():
        places.sort()
        assert [o for o, _ in places] == [sum(n for _, n in places[:k]) for k in range(len(places))]
        assert sum(n for _, n in places) <= 2048


def test_an_empty_corpus_runs_through(few):
    docs = table(few, DIRECTORY, "documents").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = kept(stage(few, docs, DIRECTORY), name)
    assert docs.count() == 0
