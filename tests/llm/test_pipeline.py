"""Every stage of the pipeline against brute force on what the stage before kept, on a small table with planted cases."""

import pytest

import corpus_pipeline
from tests.llm.test_native import brute_hits
from tests.llm.test_ngram_join import brute as brute_groups
from tests.llm.test_suffix_dedup import brute as brute_removed


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """The smallest given documents with planted rows, and a benchmark."""
    path = str(tmp_path_factory.mktemp("tables"))
    given = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    rows = [tuple(r) for r in given.collect()]
    clean = rows[7][1]
    passage = bench.first()["text"]
    planted = [
        (9001, rows[3][1], "fr", "planted", 0),
        (9002, clean + " onemore", None, None, None),
        (9003, "Brand new words begin here " + rows[9][1][:400] + " and here they end.", "en", "x", 1),
        (9004, f"Nothing else of note. {passage} Nothing at all.", "en", "x", 1),
        (9005, None, "en", "x", 0),
        (9006, "12345 !!! ???", "en", "x", 0),
    ]
    spark.createDataFrame(rows + planted, given.schema).repartition(3).write.parquet(f"{path}/documents.parquet")
    bench.write.parquet(f"{path}/benchmark.parquet")
    return path


@pytest.fixture(scope="module")
def steps(spark, folder, tmp_path_factory):
    """(name, input rows, output rows) of each stage, and the result of the whole."""
    docs, out = spark.read.parquet(f"{folder}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        path = f"{tmp_path_factory.mktemp('stage')}/{name}"
        stage(spark, docs, folder).write.parquet(path)
        done = spark.read.parquet(path)
        out.append((name, docs.collect(), done.collect(), done.columns))
        docs = done
    return {name: rest for name, *rest in out}, corpus_pipeline.run(spark, folder).collect()


def test_languages(steps):
    before, after, columns = steps[0]["language_id"]
    gone = {r["doc_id"] for r in before} - {r["doc_id"] for r in after}
    assert columns == corpus_pipeline.COLUMNS and gone == {9005, 9006}
    assert {r["doc_id"]: r["lang"] for r in after}[9002] == "en"


def test_passages(steps):
    before, after, columns = steps[0]["suffix_dedup"]
    removed = brute_removed([(r["doc_id"], r["text"]) for r in before], 50)
    assert columns == corpus_pipeline.COLUMNS and removed[9003][1] >= 300
    text = {r["doc_id"]: r["text"] for r in before}
    for r in after:
        if removed[r["doc_id"]][1]:
            left = removed[r["doc_id"]][0] - removed[r["doc_id"]][1]
            assert left - 6 * removed[r["doc_id"]][2] <= len(r["text"].encode()) <= left and r["n_chars"] == len(r["text"])
        else:
            assert r["text"] == text[r["doc_id"]]
    assert {d for d in text if removed[d][0] > removed[d][1] + 6} <= {r["doc_id"] for r in after}


def test_benchmark(spark, folder, steps):
    before, after, columns = steps[0]["decontamination"]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    bad = {row[0] for row in brute_hits([(r["doc_id"], r["text"]) for r in before], items, 10) if row[5]}
    assert columns == corpus_pipeline.COLUMNS and 9004 in bad
    assert {r["doc_id"] for r in before} - {r["doc_id"] for r in after} == bad


def test_packing_and_whole_run(steps):
    before, after, _ = steps[0]["packing"]
    assert {r["doc_id"] for r in before} == {r["doc_id"] for r in after}
    piece = lambda r: (r["doc_id"], r["start"], r["length"], r["ids_crc32"])
    assert sorted(map(piece, after)) == sorted(map(piece, steps[1]))


def test_groups_of_five_words_and_four_fifths(steps):
    before, after, columns = steps[0]["ngram_join"]
    groups = brute_groups([(r["doc_id"], r["text"]) for r in before], 5, 80)
    assert columns == corpus_pipeline.COLUMNS and not {9001, 9002} & {r["doc_id"] for r in after}
    assert sorted(r["doc_id"] for r in after) == sorted(doc for doc, (_, group) in groups.items() if doc == group)


def test_near_copies_between_both_thresholds_are_one(spark, frame):
    words = [f"w{i}" for i in range(100)]
    near = [*words[:30], "x", *words[31:60], "y", *words[61:]]
    far = [*words[:20], "p", *words[21:50], "q", *words[51:80], "r", *words[81:]]
    rows = [(1, " ".join(words)), (2, " ".join(near)), (3, " ".join(far)), (4, "other words stand here")]
    assert brute_groups(rows, 3, 90)[2][1] == 2 and brute_groups(rows, 5, 80)[2][1] == 1
    docs = frame(rows).selectExpr("doc_id", "text", "'en' AS lang", "'x' AS source", "1L AS n_chars")
    kept = sorted(r["doc_id"] for r in corpus_pipeline.one_of_each_group(spark, docs, "").collect())
    assert kept == sorted(doc for doc, (_, group) in brute_groups(rows, 5, 80).items() if doc == group)


def test_rows_without_an_id_or_with_a_repeated_one_go_by_their_text(spark, frame, tmp_path):
    texts = {name: " ".join(f"{name}{i}" for i in range(100)) for name in "abcde"}
    near = lambda name: texts[name] + " more"
    rows = [(None, near("a")), (None, texts["b"]), (None, near("b")), (3, texts["a"]), (5, texts["c"]), (5, texts["d"]), (8, near("d")), (None, texts["e"])]
    docs = frame(rows).selectExpr("doc_id", "text", "'en' AS lang", "'x' AS source", "1L AS n_chars")
    kept = [(r["doc_id"], r["text"]) for r in corpus_pipeline.one_of_each_group(spark, docs, "").collect()]
    assert {row for row in kept if row[1] not in (texts["b"], near("b"))} == {(3, texts["a"]), (5, texts["c"]), (5, texts["d"]), (None, texts["e"])}
    assert len(kept) == 5  # one of the two near copies without an id
    spark.createDataFrame([(1, texts["c"][:300]), (2, texts["e"][:300])], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    left = {(r["doc_id"], r["text"]) for r in corpus_pipeline.without_benchmark(spark, docs, str(tmp_path)).collect()}
    assert left == {row for row in rows if row[1] not in (texts["c"], texts["e"])}


@pytest.mark.parametrize("rows", [[], [(1, None, None), (None, None, "en")], [(1, "", None), (2, "12", "en")], [(1, "words without a label", None)] * 2])
def test_empty_null_and_unlabelled_tables(spark, rows, tmp_path):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "'x' AS source", "1L AS n_chars", "0 AS part")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "some item")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in found} == {doc for doc, text, _ in rows if text and not text.isdigit()}
