"""Filter interactions against applying every order to every document."""

import random
import re
from itertools import permutations

from tallyloom.llm import filter_audit
from tallyloom.llm.queries import QUERIES


def failed_masks(docs):
    """{row place: set of failing letters} by plain loops."""
    found = []
    for doc, text, _ in docs:
        text = text or ""
        words = [w for w in re.split(r"[ \t-\r]+", text) if w]
        capitals = sum("A" <= c <= "Z" for c in text)
        fails = {"A"} if len(words) < 200 else set()
        fails |= {"B"} if 100 * len(set(words)) < 50 * len(words) else set()
        fails |= {"C"} if 100 * capitals > 2 * len(text) else set()
        fails |= {"D"} if set(text) & set("#$%&*|") else set()
        fails |= {"E"} if any((t or "") == text and d is not None and (doc is None or d < doc) for d, t, _ in docs) else set()
        found.append(fails)
    return found


def brute(docs, labels):
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    rows, masks = [], failed_masks(docs)
    for part in {p or "" for _, _, p in docs}:
        mine = [(doc, fails) for (doc, _, p), fails in zip(docs, masks) if (p or "") == part]
        removed_in = {}
        for order in permutations("ABCDE"):
            left = mine
            for step, name in enumerate(order, 1):
                gone = [(d, f) for d, f in left if name in f]
                left = [(d, f) for d, f in left if name not in f]
                removed_in[order, name] = len(gone)
                rows.append([
                    part, "".join(order), step, len(left), len(gone), sum(name in f for _, f in mine) - len(gone),
                    sum(f == {name} for _, f in mine), sum(d in good for d, _ in gone), sum(d in toxic for d, _ in gone), name,
                ])
        totals = {name: sum(n for (_, other), n in removed_in.items() if other == name) for name in "ABCDE"}
        for row in rows:
            if row[0] == part:
                row[9] = totals.get(row[9], row[9])
    return sorted(tuple(row) for row in rows)


def corpus(seed=5, n=120):
    rnd = random.Random(seed)
    texts = [None, "", "#", "A", " \n\t"]
    for _ in range(25):
        words = [rnd.choice("abcdefgh") * rnd.randint(1, 30) if rnd.random() < 0.7 else f"w{i}" for i in range(rnd.choice([3, 199, 200, 320]))]
        text = " ".join(words)
        texts.append((text.upper() if rnd.random() < 0.3 else text) + rnd.choice(["", "", "$", "|"]))
    docs = [(doc, rnd.choice(texts), rnd.choice(["x", "x", "x", "y", "", None])) for doc in range(n)]
    docs += [(None, texts[6], "x"), (None, texts[6], "z"), (None, "only without an id", "z"), (None, "only without an id", "z")]
    docs += [(7, docs[7][1], "x"), (7, "another text of seven", "x")]
    docs += [(1000 + i, "many copies", "y") for i in range(40)]
    docs += [(2000, "long and dull " * 60_000, "x")]
    labels = [(doc, rnd.choice([0, 1, None]), rnd.choice([0, 1, None])) for doc in range(0, n, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1), (99_999, 1, 1)]
    return docs, labels


def frames(spark, docs, labels):
    documents = spark.createDataFrame(docs, "doc_id long, text string, source string")
    return documents.selectExpr("*", "1 AS part", "2 AS mask", "'q' AS quality", "3 AS digest", "4 AS good"), spark.createDataFrame(
        labels, "doc_id long, quality int, toxic int"
    ).selectExpr("*", "'t' AS text", "'s' AS source")


def test_equals_applying_each_order(spark, rows):
    docs, labels = corpus()
    found = filter_audit.audit(filter_audit.masks(*frames(spark, docs, labels)))
    assert sorted(map(tuple, found.collect())) == brute(docs, labels)


def test_a_single_null_table_and_an_empty_one(spark):
    docs = [(1, None, None)]
    assert sorted(map(tuple, filter_audit.audit(filter_audit.masks(*frames(spark, docs, []))).collect())) == brute(docs, [])
    assert filter_audit.audit(filter_audit.masks(*frames(spark, [], []))).collect() == []


def test_walk_visits_every_order():
    for n in range(1, 7):
        order, seen = list(range(n)), {tuple(range(n))}
        for place in filter_audit.by_adjacent_swaps(n):
            order[place], order[place + 1] = order[place + 1], order[place]
            seen.add(tuple(order))
        assert len(seen) == len(list(permutations(range(n))))


def test_nodes_are_shared_and_swaps_keep_the_counts():
    counts = {mask: (mask % 3, 0, 0) for mask in range(32)}
    diagram = filter_audit.Diagram("ABCDE", counts)
    total = diagram.nodes[diagram.root][2]
    assert len(filter_audit.Diagram("ABCDE", dict.fromkeys(range(32), (1, 0, 0))).nodes) == 6
    rnd = random.Random(3)
    for _ in range(200):
        diagram.swap(rnd.randrange(4))
        assert diagram.nodes[diagram.root][2] == total
        node = diagram.root
        for place in range(5):  # a random path ends at the count of its mask
            node = diagram.nodes[node][1]
        assert diagram.nodes[node][2] == counts[31]


def test_query(spark, tmp_path):
    docs, labels = corpus(8, 60)
    docs = [d for d in docs if d[0] is not None]
    documents, truth = frames(spark, docs, labels)
    documents.write.parquet(f"{tmp_path}/documents.parquet")
    truth.write.parquet(f"{tmp_path}/labels.parquet")
    df = QUERIES["op12_filter_audit"](spark, str(tmp_path))
    assert df.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert [t for _, t in df.dtypes] == ["string", "string", "int"] + ["bigint"] * 7
    assert sorted(map(tuple, df.collect())) == brute(docs, labels)
