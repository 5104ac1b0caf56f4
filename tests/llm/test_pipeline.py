import numpy as np
import pytest
from test_decontaminate import by_hand as contaminated_by_hand
from test_near_dup import classes_by_hand
from test_secrets import scan_by_hand

import __spark_entry__ as registry
import corpus_pipeline as cp
from ledgerloom.llm import bpe, secrets, toxicity

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Each stage's output, written and read again, beginning with the documents."""
    outputs = [spark.read.parquet(f"{SMALL}/documents.parquet")]
    for name, stage in cp.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, outputs[-1], SMALL).write.parquet(path)
        outputs.append(spark.read.parquet(path))
    return outputs


def by_id(df):
    rows = df.orderBy("doc_id").collect()
    assert len({r.doc_id for r in rows}) == len(rows)
    return {r.doc_id: r for r in rows}


def test_columns_and_registration(stages):
    assert [name for name, _ in cp.STAGES] == ["toxicity", "near_duplicates", "decontamination", "secrets", "bpe"]
    for df in stages[:-1]:
        assert df.columns == cp.COLUMNS
    assert registry.queries()["pipeline"] is cp.run and "pipeline" not in registry.oracle_sql()


def test_toxic_documents_go(spark, stages):
    machine = toxicity.learn_toxicity(stages[0], spark.read.parquet(f"{SMALL}/labels.parquet"))
    before, after = by_id(stages[0]), by_id(stages[1])
    scores = toxicity.Scorer(machine).score([r.text for r in before.values()])
    assert set(after) == {i for i, s in zip(before, scores) if s < toxicity.THRESHOLD}
    assert all(after[i] == before[i] for i in after) and len(after) >= 0.8 * len(before)


def test_one_of_each_class_stays(stages):
    before, after = by_id(stages[1]), by_id(stages[2])
    ids = list(before)
    classes = classes_by_hand([before[i].text for i in ids])
    assert set(after) == {ids[c] for c in classes} and all(after[i] == before[i] for i in after)


def test_contaminated_documents_go(spark, stages):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    before, after = by_id(stages[2]), by_id(stages[3])
    clean = {i for i, r in before.items() if not contaminated_by_hand(r.text, items)[3]}
    assert set(after) == clean and len(clean) < len(before) and all(after[i] == before[i] for i in after)


def test_secrets_are_masked(stages):
    forest = secrets.learn_from_documents(stages[3])
    before, after = by_id(stages[3]), by_id(stages[4])
    assert list(after) == list(before)
    for i, r in before.items():
        masked = scan_by_hand(r.text, r.source, forest)[1]
        assert (after[i].text, after[i].n_chars) == (masked, len(masked))


def test_a_planted_secret_is_masked(spark, stages):
    planted = spark.createDataFrame([(10**9, "words password=da3fe1beadc3e135f8 words", "en", "src0", 39)], stages[3].schema)
    row = cp.mask_secrets(spark, stages[3].unionByName(planted), SMALL).where(f"doc_id = {10**9}").first()
    assert (row.text, row.n_chars) == ("words password=[SECRET] words", 29)


def test_texts_are_encoded(stages):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(bpe.default_vocabulary())
    before, after = by_id(stages[4]), by_id(stages[5])
    assert list(after) == list(before)
    for i, r in before.items():
        ids = library.encode(r.text, add_special_tokens=False).ids
        assert bytes(after[i].ids) == np.array(ids, "<u4").tobytes() and after[i].n_tokens == len(ids) and after[i].decoded == r.text


def test_run_is_the_stages_in_a_row(spark, stages):
    got = {r.doc_id: (r.n_tokens, bytes(r.ids)) for r in cp.run(spark, SMALL).collect()}
    assert got == {i: (r.n_tokens, bytes(r.ids)) for i, r in by_id(stages[-1]).items()}


def test_no_documents(spark, tmp_path):
    for table in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SMALL}/{table}.parquet").limit(0).write.parquet(str(tmp_path / f"{table}.parquet"))
    assert cp.run(spark, str(tmp_path)).count() == 0
