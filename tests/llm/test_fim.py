"""Fill-in-the-middle against a plain loop over lines."""

from hashlib import sha256

import pytest
from hypothesis import given
from hypothesis import strategies as st

from tallyloom.llm import fim
from tallyloom.llm.queries import QUERIES
from tallyloom.llm.fim import transform

TEXTS = [None, "", "\n", "a", "a\n", "\n\n", "a\nb", "é漢\n\n\nx\r\ny\n", "with <M> inside\nb", "<\n<S\n<P\n>", "<S\n>\n<", "x" * 50_000 + "\n" + "y\n" * 3_000]


def plain(doc, text, seed=7, percent=100, spm_percent=50):
    text, units, unit = text or "", [], ""
    for c in text:
        unit += c
        if c == "\n":
            units.append(unit)
            unit = ""
    units += [unit] if unit else []
    n, digest = len(units), sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    if not text or "<P>" in text or "<S>" in text or "<M>" in text or h[2] % 100 >= percent:
        return (doc, n, "plain", None, None, text)
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    if h[3] % 100 < spm_percent:
        return (doc, n, "spm", len(prefix), len(middle), "<S>" + suffix + "<P>" + prefix + "<M>" + middle)
    return (doc, n, "psm", len(prefix), len(middle), "<P>" + prefix + "<S>" + suffix + "<M>" + middle)


def cases():
    rows = [(doc, text) for doc, text in enumerate(TEXTS * 6)]
    return rows + [(None, "a\nb\nc"), (None, "a\nb\nc"), (3, "other\ntext"), (3, "a"), (-5, "a\nb\nc\nd")]


@pytest.mark.parametrize("settings", [{}, {"seed": 1, "percent": 40, "spm_percent": 100}, {"percent": 0}, {"spm_percent": 0}])
def test_equals_plain_loop(frame, settings):
    rows = cases()
    found = sorted((tuple(r) for r in transform(frame(rows), **settings).collect()), key=str)
    assert found == sorted((plain(*row, **settings) for row in rows), key=str)


def test_texts_are_restored(frame):
    rows = cases()
    outputs = transform(frame(rows)).withColumn("restored", fim.restored())
    assert sorted(((r.doc_id, r.restored) for r in outputs.collect()), key=str) == sorted(((d, t or "") for d, t in rows), key=str)
    assert {r.form for r in outputs.select("form").collect()} == {"plain", "psm", "spm"}


@given(st.lists(st.text(alphabet="<PSM>\na é", max_size=30), min_size=1, max_size=5))
def test_restored_whatever_the_text(texts):
    import re

    for doc, text in enumerate(texts):
        _, _, form, _, _, output = plain(doc, text)
        pieces = re.split("<[PSM]>", output)
        order = {"psm": (1, 3, 2), "spm": (2, 3, 1)}.get(form)
        assert (output if order is None else "".join(pieces[i] for i in order)) == text


def test_other_units(frame):
    found = transform(frame([(1, "one two  three")]), unit=r"\s*\S+\s*").first()
    assert found.n == 3


def test_empty_table(frame):
    assert fim.digests(transform(frame([]))).collect() == []


def test_query(spark, tmp_path):
    rows = [(doc, text) for doc, text in cases() if doc is not None]
    spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'en' AS lang").write.parquet(f"{tmp_path}/documents.parquet")
    df = QUERIES["op11_fim"](spark, str(tmp_path))
    assert df.dtypes == [
        ("doc_id", "bigint"), ("n", "bigint"), ("form", "string"), ("prefix_chars", "bigint"), ("middle_chars", "bigint"),
        ("output_sha256", "string"), ("restored_sha256", "string"),
    ]
    digest = lambda text: sha256((text or "").encode()).hexdigest()
    want = [(*plain(doc, text)[:5], digest(plain(doc, text)[5]), digest(text)) for doc, text in rows]
    assert sorted(map(tuple, df.collect()), key=str) == sorted(want, key=str)
