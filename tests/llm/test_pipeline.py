"""The pipeline, stage by stage against plain versions, and as a whole."""

import corpus_pipeline
import pytest
from rows import DOCUMENTS, odd
from test_near_dedup import classes
from test_tokens import JSON, check_packing

from lanehouse.llm.queries import QUERIES


@pytest.fixture(scope="module")
def folder():
    return "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def steps(spark, folder):
    """What each stage made of what the one before had kept."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = [docs.collect()]
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder).cache()
        kept.append(docs.collect())
    return kept


def by_id(rows):
    return {r.doc_id: r for r in rows}


def test_rejected_documents_go(spark, folder, steps):
    accepted = {r.doc_id for r in QUERIES["op6_quality_classifier"](spark, folder).collect() if r.predicted}
    assert set(by_id(steps[1])) == accepted and len(accepted) < len(steps[0])
    before = by_id(steps[0])
    assert all(before[r.doc_id] == r for r in steps[1])
    labels = by_id(spark.read.parquet(f"{folder}/labels.parquet").collect())
    good = [i for i in before if i in labels and labels[i].quality == 1]
    assert sum(i in accepted for i in good) >= 0.97 * len(good)


def test_boilerplate_lines_go(steps):
    pages: dict = {}
    for r in steps[1]:
        pages.setdefault(r.source, []).append({line.strip(" ") for line in r.text.split("\n")} - {""})
    after = by_id(steps[2])
    assert len(after) == len(steps[1])
    for r in steps[1]:
        own = pages[r.source]

        def gone(line, own=own):
            n = sum(line in page for page in own)
            return bool(line) and n >= 2 and n > 0.1 * len(own)

        text = "\n".join(line for line in r.text.split("\n") if not gone(line.strip(" ")))
        assert after[r.doc_id].text == text and after[r.doc_id].n_chars == len(text)


def test_one_document_of_each_class_stays(steps):
    rows = [(r.doc_id, r.text) for r in steps[2]]
    assert set(by_id(steps[3])) == {c for _, c in classes(rows)}
    before = by_id(steps[2])
    assert all(before[r.doc_id] == r for r in steps[3]) and len(steps[3]) < len(steps[2])


def test_documents_with_benchmark_items_go(spark, folder, steps):
    items = [r.text for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    leaked = {r.doc_id for r in steps[3] if any(t.strip(" .")[2:] in r.text for t in items)}
    left = set(by_id(steps[4]))
    assert leaked and not leaked & left
    assert len(left) >= 0.99 * (len(steps[3]) - len(leaked))


def test_the_rest_is_packed(steps):
    from tokenizers import Tokenizer

    tokens = Tokenizer.from_file(JSON)
    docs = [(r.doc_id, r.text) for r in steps[4]]
    check_packing(steps[5], docs, lambda t: tokens.encode(t, add_special_tokens=False).ids, 2048)


def test_run_gives_what_the_stages_give(spark, folder, steps):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "line_dedup", "near_dedup", "decontamination", "best_fit_packing",
    ]
    pieces = lambda rows: sorted((r.doc_id, r.piece, r.ids_crc32) for r in rows)
    assert pieces(corpus_pipeline.run(spark, folder).collect()) == pieces(steps[5])


@pytest.mark.parametrize("empty", [False, True])
def test_stages_stand_odd_rows(spark, tmp_path, empty):
    # two more texts are a word after very long white space: near copies of each other
    blank = [(8, " " * 1_500_000 + "x", "en", "d", 1), (9, "\n" * 1_500_000 + "x", "en", "e", 1)]
    docs = odd(spark).unionByName(spark.createDataFrame(blank, DOCUMENTS), allowMissingColumns=True)
    docs = docs.limit(0) if empty else docs
    tables = {
        "documents": docs,
        "labels": spark.createDataFrame([], "doc_id long, quality int, toxic int"),
        "benchmark": spark.createDataFrame([(1, None), (None, "")], "item_id long, text string"),
    }
    for name, table in tables.items():
        table.write.parquet(f"{tmp_path}/{name}.parquet")
    given = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        given = stage(spark, given, str(tmp_path))
        assert given.dtypes == spark.createDataFrame([], DOCUMENTS).dtypes
    assert given.count() == (0 if empty else 9)
    assert corpus_pipeline.run(spark, str(tmp_path)).isEmpty() == empty
