import re
from collections import defaultdict

import pytest

from tallyloom.llm.ngram_join import least_reachable, linked_groups


def brute(rows, words, percent):
    sets = {}
    for doc, text in rows:
        found = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
        size = min(words, len(found))
        sets[doc] = frozenset(tuple(found[i : i + size]) for i in range(len(found) - size + 1)) if found else frozenset()
    group = {doc: doc for doc in sets}

    def find(doc):
        while group[doc] != doc:
            doc = group[doc]
        return doc

    for a in sets:
        for b in sets:
            shared = len(sets[a] & sets[b])
            if a < b and shared and 100 * shared >= percent * len(sets[a] | sets[b]):
                one, two = find(a), find(b)
                group[max(one, two)] = min(one, two)
    return {doc: (len(sets[doc]), find(doc)) for doc in sets}


@pytest.mark.parametrize(("block", "words", "percent"), [(4096, 3, 90), (5, 3, 90), (4096, 5, 80)])
def test_groups(frame, documents, block, words, percent):
    found = linked_groups(frame(documents), words=words, percent=percent, block=block).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == brute(documents, words, percent)


def test_many_near_copies_are_one_group(frame):
    words = [f"w{i}" for i in range(100)]
    rows = [(i, " ".join([*words[: i % 90], f"x{i}", *words[i % 90 + 1 :]])) for i in range(300)]
    found = {r["doc_id"]: r["component_id"] for r in linked_groups(frame(rows)).collect()}
    assert found == {doc: group for doc, (_, group) in brute(rows, 3, 90).items()}


def test_empty_table_null_ids_and_repeated_rows(frame):
    assert linked_groups(frame([])).count() == 0
    rows = [(4, "a b c d"), (4, "a b c d"), (None, "A B C D"), (9, None), (8, ""), (None, " ")]
    found = sorted(((r["doc_id"] or 0), r["n_shingles"], r["component_id"] or 0) for r in linked_groups(frame(rows)).collect())
    assert found == [(0, 0, 0), (0, 2, 4), (4, 2, 4), (4, 2, 4), (8, 0, 8), (9, 0, 9)]


def test_least_reachable_on_a_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(20)] + [(50, 51)], "node long, other long")
    labels = {r["node"]: r["least"] for r in least_reachable(edges).collect()}
    assert labels == defaultdict(int, {**{i: 0 for i in range(21)}, 50: 50, 51: 50})


def test_texts_under_a_null_or_repeated_id_link_on_their_own(frame):
    texts = {name: " ".join(f"{name}{i}" for i in range(100)) for name in "abcd"}
    near = lambda name: texts[name] + " more"
    rows = [(None, texts["a"]), (None, texts["b"]), (None, texts["c"]), (3, near("a")), (5, texts["d"]), (5, near("b")), (8, near("d"))]
    found = sorted(((r["doc_id"] or 0), r["n_shingles"], r["component_id"] or 0) for r in linked_groups(frame(rows)).collect())
    assert found == [(0, 98, 0), (0, 98, 3), (0, 98, 5), (3, 99, 3), (5, 98, 5), (5, 99, 5), (8, 99, 5)]
