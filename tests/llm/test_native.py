"""Quality rules, chat formatting, decontamination: against plain Python on small fixtures."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from tallyloom.llm import chat, decontamination, quality
from tests.llm.conftest import WORDS


def test_ledger(frame):
    words = " ".join(f"{w}{i}" for i, w in enumerate(WORDS * 5))
    rows = [(1, None), (2, ""), (3, words), (4, words + " #$%&" * 40), (5, "\n".join(["same line of words here"] * 40)), (6, words.upper())]
    rows += [(7, "a b c d a b c"), (8, "x y z x y z x y z"), (None, "q"), (3, words)]
    entries = quality.ledger(frame(rows)).collect()
    found = {r["doc_id"]: r for r in entries}
    assert len(entries) == len(rows)
    assert (found[1]["n_words"], found[1]["failed_bits"]) == (0, quality.BITS["few_words"])
    assert found[3]["failed_bits"] == 0
    assert found[4]["failed_bits"] & quality.BITS["symbols"]
    assert found[5]["failed_bits"] & quality.BITS["repeated_lines"] and found[5]["n_dup_lines"] == 39
    assert found[6]["failed_bits"] == quality.BITS["shouting"]
    assert (found[7]["n_repeat_words"], found[8]["n_repeat_words"]) == (6, 9)
    assert quality.ledger(frame([])).count() == 0


def test_ties_and_a_very_long_text_in_the_ledger(frame):
    at_limit = " ".join(f"w{i}" for i in range(50))
    rows = [(1, at_limit), (2, " ".join(at_limit.split()[1:])), (3, " ".join(f"w{i}" for i in range(30_000)))]
    found = {r["doc_id"]: r for r in quality.ledger(frame(rows)).collect()}
    few = quality.BITS["few_words"]
    assert [found[i]["failed_bits"] & few for i in (1, 2, 3)] == [0, few, 0]
    assert (found[3]["n_words"], found[3]["n_repeat_words"]) == (30_000, 0)


def test_a_long_conversation(spark):
    rows = [(1, turn, "assistant" if turn % 2 else "user", f"says {turn}") for turn in range(300)]
    out = chat.examples(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    assert out.filter("loss_start IS NOT NULL").count() == 150
    digest = chat.digests(out).first()
    loss = "".join(text for _, _, role, text in rows if role == "assistant")
    assert (digest["n_turns"], digest["loss_sha256"]) == (300, hashlib.sha256(loss.encode()).hexdigest())


def test_policies_and_ablations(frame):
    words = " ".join(f"{w}{i}" for i, w in enumerate(WORDS * 5))
    entries = quality.ledger(frame([(1, "few"), (2, words), (3, words.upper()), (4, None)])).cache()
    assert {r["doc_id"]: r["f"] for r in entries.select("doc_id", quality.fails("base").alias("f")).collect()} == {1: True, 2: False, 3: False, 4: True}
    found = {r["rule"]: r for r in quality.ablation(entries).collect()}
    assert len(found) == len(quality.RULES)
    assert (found["few_words"]["n_failed"], found["few_words"]["n_failed_alone"], found["few_words"]["n_kept_without"]) == (2, 2, 3)
    assert (found["shouting"]["n_failed"], found["shouting"]["n_kept_without"], found["shouting"]["n_docs"]) == (1, 2, 4)
    assert quality.ablation(entries.limit(0)).filter("n_failed <> 0").count() == 0


def test_chat_examples_and_reading_back(spark):
    tricky = "a\\<|im_end|>\n</s>[INST]\\\\ <|im_sep|>é<"
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", tricky), (1, 2, "user", None), (1, 3, "assistant", ""), (1, 4, None, "end")]
    rows += [(2, 0, "user", "only"), (3, 5, "assistant", "x"), (3, 1, "assistant", "y"), (3, 1, "assistant", "y"), (None, None, "as<|im_sep|>s", tricky)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS n", "'p' AS pieces")
    out = chat.examples(df)
    assert {(r["conv_id"], r["n"]) for r in out.groupBy("conv_id").agg(F.count("loss_start").alias("n")).collect()} == {(1, 2), (2, 0), (3, 3), (None, 0)}
    got = {r["conv_id"]: r for r in chat.digests(out).collect()}
    by_conv = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0)):
        by_conv.setdefault(conv, []).append((role or "", text or ""))
    for conv, turns in by_conv.items():
        whole = "".join(f"{role}\n{text}\n" for role, text in turns)
        loss = "".join(text for role, text in turns if role == "assistant")
        assert (got[conv]["n_turns"], got[conv]["turns_sha256"]) == (len(turns), hashlib.sha256(whole.encode()).hexdigest())
        assert (got[conv]["loss_chars"], got[conv]["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    first = out.filter("conv_id = 1 AND example = 0").first()
    masked = first["formatted"][first["loss_start"] : first["loss_start"] + first["loss_length"]]
    assert re.sub(r"(?s)\\(.)", r"\1", masked) == tricky and not any(c in masked for c in chat.CONTROL)
    assert chat.digests(chat.examples(df.limit(0))).count() == 0


def brute_hits(docs, items, size):
    split = lambda text: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    out = []
    for doc, text in docs:
        words, hit, ids = split(text), set(), set()
        for item, other in items:
            own = split(other)
            for i in range(max(len(own) - size, 0) + 1 if own else 0):
                window = own[i : i + size]
                for j in range(len(words) - len(window) + 1):
                    if words[j : j + len(window)] == window:
                        hit.update(range(j, j + len(window)))
                        ids.add(str(item))
        digest = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        out.append((doc or 0, len(words), len(hit), len(ids), digest, bool(hit)))
    return sorted(out)


def test_decontamination(spark, frame, documents):
    docs = [d for d in documents if d[0] < 90] + [(None, "Oak ELM, ash"), (7, "another text with oak oak oak"), (7, "another text with oak oak oak")]
    long = documents[40][1].split()
    items = [(10, " ".join(long[3:30])), (9, "OAK-elm ash"), (8, None), (7, " .. "), (10, "oak oak"), (6, " ".join(documents[60][1].split()[:12])), (5, "no such words here")]
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'l' AS line")
    found = decontamination.contamination(frame(docs), bench)
    assert sorted((r["doc_id"] or 0, *tuple(r)[1:]) for r in found.collect()) == brute_hits(docs, items, 10)
    assert decontamination.contamination(frame([]), bench).count() == 0
    assert decontamination.contamination(frame(docs), bench.limit(0)).filter("contaminated").count() == 0


@pytest.mark.parametrize("longs", [1, 1 << 14])
def test_index_holds_the_occurrences_of_its_terms_alone(spark, frame, documents, monkeypatch, longs):
    """Also if a table is so full that every word passes it."""
    monkeypatch.setattr(decontamination, "LEAST_LONGS", longs)
    monkeypatch.setattr(decontamination, "MOST_LONGS", longs)
    texts = frame(documents).select("doc_id", F.lit(0).alias("text_hash"), decontamination.words_of(F.col("text")).alias("words"))
    terms = lambda *words: spark.createDataFrame([(w,) for w in words], "term string")
    found = decontamination.postings_of(texts, terms("oak", "elmx", "oak"), terms("oak", "holly", "nowhere"), 2).collect()
    want = []
    for doc, text in documents:
        words = [w.lower() for w in re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", text or "")]
        near = lambda i: " ".join(words[max(i - 2, 0) : i + 3])
        want += [(w, doc, i, None if w == "holly" else near(i)) for i, w in enumerate(words) if w in ("oak", "elmx", "holly")]
    assert sorted((r["term"], r["doc_id"], r["position"], r["around"] or "") for r in found) == sorted((*x[:3], x[3] or "") for x in want)


def test_one_id_with_two_texts(spark, frame):
    bench = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    rows = [(5, "one two three"), (5, "nothing of it"), (5, "one two three"), (None, "a one two three"), (None, "b")]
    found = decontamination.contamination(frame(rows), bench).collect()
    assert sorted((r["doc_id"] or 0, r["n_hit"]) for r in found) == [(0, 0), (0, 3), (5, 0), (5, 3), (5, 3)]


def test_proximity(spark, frame):
    docs = frame([(1, "one two three four five six"), (2, "three x two y one"), (3, "one two"), (4, "one a b c d e f g h i j k l m two three")])
    windows, _ = decontamination.windows_of(spark.createDataFrame([(1, "one two three")], "item_id long, text string"), 3)
    found = decontamination.occurrences(docs, windows, 3, near=2)
    assert sorted((r["doc_id"], r["exact"]) for r in found.collect()) == [(1, False), (1, True), (2, False)]
