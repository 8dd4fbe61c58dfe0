from collections import Counter

import corpus_pipeline
from staywise.llm import jaccard_join, quality
from staywise.llm.registry import QUERIES

from .conftest import COLUMNS, SF
from .test_dedup_mixing import squeezed
from .test_packing_tokens import check_pieces
from .test_similarity import brute_links


def test_stages_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    steps = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{k}")
        steps.append([(r.doc_id, r.text) for r in docs.collect()])
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        assert k == len(corpus_pipeline.STAGES) - 1 or docs.columns == columns
    whole, good, single, apart, mixed = steps

    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    marks = {r.doc_id: r.quality for r in labels}
    gone = {i for i, _ in whole} - {i for i, _ in good}
    bad = [i for i, _ in whole if marks.get(i) == 0]
    assert not [i for i in gone if marks.get(i) == 1] and len(gone & set(bad)) >= 0.7 * len(bad)

    first = {}
    for i, t in sorted(good):
        first.setdefault(squeezed(t), (i, t))
    assert sorted(single) == sorted(first.values())

    assert sorted(i for i, _ in apart) == sorted({c for _, _, c in brute_links(single)})
    assert {x for x in mixed} <= {x for x in apart} and max(Counter(mixed).values()) <= 3
    assert check_pieces(docs.collect(), mixed) < 0.05


def test_registry_has_every_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_stages_on_edges(spark, edge, nothing):
    for df in (edge, nothing):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, df, SF).columns == COLUMNS
            stage(spark, df, SF).count()
        corpus_pipeline.pack_sequences(spark, df, SF).count()


def test_operators_are_those_of_the_stages():
    assert quality.THRESHOLD == 0.3 and jaccard_join.SIMILARITY == 0.8
