"""What the driver holds of the models: one at a time while they are gathered, none once the texts are measured."""

import pyarrow as pa
from pyspark.sql.classic.dataframe import DataFrame

from gridvoice.llm import kneser_ney as kn


def test_models_are_gathered_one_by_one_and_let_go(spark, monkeypatch):
    gathered, trained = [], []
    plain, train = DataFrame.toArrow, kn.train

    def to_arrow(self):
        gathered.append(plain(self))
        return gathered[-1]

    def watched(trusted):
        trained.append(train(trusted))
        return trained[-1]

    monkeypatch.setattr(DataFrame, "toArrow", to_arrow)
    monkeypatch.setattr(kn, "train", watched)
    docs = spark.createDataFrame([(n, f"text {n % 7} of some {n} words", "en") for n in range(60)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(n, 1) for n in range(50)], "doc_id long, quality int")
    assert kn.classify(docs, labels).count() == 60
    assert len(gathered) == 2 * 5
    assert not trained[0]._jbroadcast.isValid()


def test_symbols_of_chunks_and_slices():
    rows = [bytes([k, 0, 0, 0, k + 1, 0, 0, 0]) for k in range(9)]
    grams = pa.chunked_array([pa.array(rows[:4], pa.binary()), pa.array(rows, pa.binary()).slice(4), pa.array([], pa.binary())])
    assert kn._symbols(grams, 2).tolist() == [[k, k + 1] for k in range(9)]
    assert kn._symbols(pa.chunked_array([pa.array([b"", b""])]), 0).shape == (2, 0)
    assert kn._symbols(pa.chunked_array([], pa.binary()), 4).shape == (0, 4)
