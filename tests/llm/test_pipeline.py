"""The pipeline's stages on small tables."""

import os

import pytest

import corpus_pipeline as pipeline
from valuekit.llm.minhash import near_duplicates

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")


@pytest.fixture(scope="module")
def stages(spark):
    """The output of each stage, run as the pipeline runs them."""
    import tempfile
    out = tempfile.mkdtemp(prefix="pipeline-test-")
    docs, made = spark.read.parquet(f"{SF}/documents.parquet"), []
    for i, (name, stage) in enumerate(pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{out}/{i}")
        docs = spark.read.parquet(f"{out}/{i}")
        made.append(docs)
    return made


def test_order_and_columns(spark, stages):
    columns = spark.read.parquet(f"{SF}/documents.parquet").columns
    assert [n for n, _ in pipeline.STAGES] == ["toxicity", "quality", "near_duplicates", "substring_dedup", "packing"]
    assert all(s.columns == columns for s in stages[:4])


def test_labels_agree_with_the_filters(spark, stages):
    labels = {r.doc_id: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    docs = [r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    after_toxic, after_quality = ({r.doc_id for r in s.collect()} for s in stages[:2])
    toxic = [d for d in docs if d in labels and labels[d].toxic == 1]
    clean = [d for d in docs if d in labels and labels[d].toxic == 0]
    assert sum(d not in after_toxic for d in toxic) >= 0.6 * len(toxic)  # few labels at this size
    assert sum(d in after_toxic for d in clean) >= 0.98 * len(clean)
    good = [d for d in after_toxic if d in labels and labels[d].quality == 1]
    assert sum(d in after_quality for d in good) >= 0.95 * len(good)


def test_one_of_each_group_stays(stages):
    components = {r.doc_id: r.component_id for r in near_duplicates(stages[1]).collect()}
    assert {r.doc_id for r in stages[2].collect()} == set(components.values())


def test_passages_go_and_ids_are_packed(stages):
    before = {r.doc_id: r.text for r in stages[2].collect()}
    after = {r.doc_id: r for r in stages[3].collect()}
    assert set(before) == set(after)
    assert all(r.text == before[d] or len(r.text) < len(before[d]) and r.n_chars == len(r.text) for d, r in after.items())
    pieces = stages[4].collect()
    assert {r.doc_id for r in pieces} == set(after)
    for d in after:
        own = [r for r in pieces if r.doc_id == d]
        assert sum(r.length for r in own) == own[0].doc_tokens


def test_the_rest_works_without_this_part():
    """The entry leaves the queries out if the subpackage is not there."""
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    code = ("import sys; sys.modules['valuekit.llm'] = None; sys.modules['corpus_pipeline'] = None; "
            "import __spark_entry__ as e; names = e.queries(); "
            "assert 'q01_csv_roundtrip' in names and not any(n.startswith('op') or n == 'pipeline' for n in names)")
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True)
