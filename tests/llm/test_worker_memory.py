"""What Python workers hold while they work and after their task."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

import corpus_pipeline
from ferrolith.llm import jaccard, langid
from ferrolith.llm.encoder import piece_encoder
from ferrolith.llm.hashing import shingle_sets
from ferrolith.llm.queries import BYTE_BPE
from ferrolith.llm.workers import frugal
from ferrolith.sources.tables import table


def test_packing_leaves_no_pieces_in_workers(spark, folder):
    docs = spark.createDataFrame([(k, f"some words of text {k}", "en", "x", 1) for k in range(64)], table(spark, folder, "documents").schema)
    assert corpus_pipeline.packing(spark, docs, folder).count() == 64

    def held(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([len(piece_encoder(BYTE_BPE).known)] * batch.num_rows)], names=["n"])

    for _ in range(3):
        assert not any(r.n for r in spark.range(16, numPartitions=16).mapInArrow(held, "n long").collect())


def test_trigram_table_is_small_and_exact():
    """Vectors of +1 and -1 take a byte a number; chunks of any size give the same sums."""
    assert langid.GramTable(langid.DIMENSIONS, 1).vectors.nbytes <= 1 << 24
    texts = [langid.gram_counts(" ".join(f"{chr(97 + k % 26)}{chr(97 + k // 26 % 26)}{chr(97 + k * 7 % 26)}é" for k in range(a, 3000, 3))) for a in range(3)]
    texts.append(langid.gram_counts("123"))
    sums = langid.GramTable(64, 1).bundle(texts)
    assert sum(len(g) for g, _ in texts) > 2 * langid.GRAMS
    for (grams, counts), row in zip(texts, sums, strict=True):
        assert (row == counts @ langid.gram_vectors(grams, 64, 1)).all()


def test_tasks_work_on_slices():
    seen = []

    def note(batches):
        for batch in batches:
            seen.append(batch.num_rows)
            yield batch

    rows = pa.RecordBatch.from_arrays([pa.array(range(5000))], names=["x"])
    out = pa.Table.from_batches(frugal(note)(iter([rows, rows.slice(0, 0), rows.slice(0, 1)])))
    assert max(seen) <= 1024 and out.column(0).to_pylist() == [*range(5000), 0]


def test_repeated_shingles(spark):
    """The table of frequent shingles holds just those that a task meets twice."""
    texts = ["a b c d e f", "a b c d e", "x y z u v w", "b c d e f g", ""]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string").coalesce(1).select(
        "doc_id", F.col("text").cast("binary"))
    values, counts = np.unique(np.concatenate(shingle_sets([t.encode() for t in texts])), return_counts=True)
    bits = jaccard._frequent(docs, 5)
    assert np.unpackbits(bits).sum() == (counts > 1).sum() == 2
    assert jaccard._has(bits, jaccard._slot(values[counts > 1])).all()
