"""The pipeline against its stages done by hand, and each stage's columns."""

import re

from odd import jaccard_components, odd_documents, odd_rows
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from sortwell.llm import mixing
from sortwell.llm.common import documents
from sortwell.llm.queries import QUERIES, VOCABULARY
from sortwell.session import settled


def survivors(rows, kept_by_language):
    """Ids that stay, from (id, text) rows."""
    rows = [r for r in rows if r[0] in kept_by_language]
    first = {}
    for i, text in sorted(rows):
        first.setdefault(re.sub("[\x20\x09-\x0d]+", " ", text or ""), (i, text))
    rows = sorted(first.values())
    component, _ = jaccard_components([text for _, text in rows])
    return [row for k, row in enumerate(rows) if component[k] == k]


def test_pipeline_equals_stages_by_hand(spark, sf):
    docs = documents(spark, sf, "doc_id", "text")
    recognised = {
        r.doc_id for r in QUERIES["op1_language_id"](spark, sf).collect() if r.lang_pred != "und" and r.score >= 0.5
    }
    want = survivors([tuple(r) for r in docs.collect()], recognised)
    found = {r.doc_id: r for r in corpus_pipeline.run(spark, sf).collect()}
    assert sorted(found) == [i for i, _ in want]
    library = Tokenizer.from_file(VOCABULARY)
    for i, text in want:
        assert found[i].ids == library.encode(text or "", add_special_tokens=False).ids
        assert found[i].n_tokens == len(found[i].ids)


def test_stages_keep_columns_of_odd_documents(spark):
    docs = odd_documents(spark)
    columns, number = docs.columns, len(odd_rows())
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, "")
        assert after.columns == columns and after.dtypes == docs.dtypes, name
        docs = settled(after)
        assert docs.count() <= number
        number = docs.count()
    ids = [r.doc_id for r in docs.collect()]
    assert 1 in ids and 4 in ids and not {2, 3, 6, 7, 8, 9, 13} & set(ids)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, "").count() == number


def test_position_is_order_of_the_mix(spark, sf, tmp_path):
    docs = documents(spark, sf)
    plan = mixing.pfair_slots(docs).select("row.doc_id", "slot", "place").collect()
    want = [r.doc_id for r in sorted(plan, key=lambda r: (r.slot, r.place))]
    order = mixing.pfair_slots(docs).repartitionByRange(5, "slot", "place").sortWithinPartitions("slot", "place").select("row.*")
    for name, at_most in (("parts", 0), ("pieces", 7)):  # also partitions of several files
        order.write.option("maxRecordsPerFile", at_most).parquet(f"{tmp_path}/{name}")
        files = spark.read.parquet(f"{tmp_path}/{name}")
        assert len(files.inputFiles()) >= 5
        found = corpus_pipeline.encoded(spark, files, sf).collect()
        assert sorted(r.position for r in found) == list(range(len(want)))
        assert [r.doc_id for r in sorted(found, key=lambda r: r.position)] == want
    found = corpus_pipeline.encoded(spark, settled(order), sf).collect()
    assert [r.doc_id for r in sorted(found, key=lambda r: r.position)] == want


def test_pipeline_gives_positions(spark, sf, monkeypatch):
    kept = {}

    def watched(spark, docs, sf_dir):
        kept["plan"] = mixing.pfair_slots(docs).select("row.doc_id", "slot", "place").collect()
        return corpus_pipeline.mixed(spark, docs, sf_dir)

    stages = [(name, watched if name == "mixing" else stage) for name, stage in corpus_pipeline.STAGES]
    monkeypatch.setattr(corpus_pipeline, "STAGES", stages)
    found = sorted(corpus_pipeline.run(spark, sf).collect(), key=lambda r: r.position)
    assert [r.doc_id for r in found] == [r.doc_id for r in sorted(kept["plan"], key=lambda r: (r.slot, r.place))]


def test_registered_queries():
    names = set(entry.queries())
    assert {"pipeline", *QUERIES} <= names and {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}


def written(spark, rows, tmp_path):
    folder = str(tmp_path / "tables")
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(
        f"{folder}/documents.parquet")
    return folder


def test_run_on_an_empty_table(spark, tmp_path):
    found = corpus_pipeline.run(spark, written(spark, [], tmp_path))
    assert found.count() == 0 and {"doc_id", "position", "ids"} <= set(found.columns)


def test_run_drops_what_no_language_has(spark, tmp_path):
    """Planted texts without a letter go in the first stage, and so do null and empty ones; the odd
    documents pass through all stages."""
    rows = [tuple(r[:5]) for r in odd_rows()]
    planted = [(100, "1234 5678 -- 90", "en", "a", 15), (101, "$$$ !!! ...", "de", "b", 11), (102, None, "en", None, None)]
    found = {r.doc_id for r in corpus_pipeline.run(spark, written(spark, rows + planted, tmp_path)).collect()}
    assert not found & {6, 7, 8, 9, 100, 101, 102} and {1, 4, 10, 17} <= found
    by_hand = {i for i, t, *_ in rows if t and any(c.isalpha() for c in t)}
    assert found <= by_hand
