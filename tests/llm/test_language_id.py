import math
import random
import zlib
from collections import Counter

import pytest

from tallyloom.llm import language_id
from tallyloom.llm.queries import QUERIES

SYLLABLES = {"aa": ["ka", "ro", "mi", "tu", "sel"], "bb": ["öst", "gra", "ünd", "ich", "eil"], "cc": ["при", "вет", "дом", "она", "лес"]}


def text(rnd, lang, words):
    return " ".join("".join(rnd.choice(SYLLABLES[lang]) for _ in range(rnd.randint(1, 4))) for _ in range(words))


@pytest.fixture
def labelled(spark):
    rnd = random.Random(2)
    rows = [(i, text(rnd, lang, rnd.randint(30, 90)).title(), lang) for i in range(300) for lang in [rnd.choice("aabbcc"[::2]) * 2]]
    rows += [(1000, "whatever", None), (1001, None, "aa")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "0 AS score", "'n' AS gram")


def test_held_out_accuracy_and_rejection(spark, labelled):
    model = language_id.fit(labelled.filter(~language_id.is_held_out()))
    found = language_id.identify(labelled.filter(language_id.is_held_out()).filter("lang IS NOT NULL AND text IS NOT NULL"), model, passing=("lang",)).collect()
    assert len(found) > 30 and all(r["lang"] == r["lang_pred"] and not r["rejected"] and 0.5 < r["score"] <= 1 for r in found)
    odd = [(1, None), (2, ""), (3, "123 ... !"), (4, "xqz wqk zzx qqx " * 40), (5, "漢字仮名交じり文" * 30), (6, SYLLABLES["aa"][0]), (6, SYLLABLES["aa"][0])]
    got = language_id.identify(spark.createDataFrame(odd, "doc_id long, text string"), model).collect()
    by = {r["doc_id"]: r for r in got}
    assert len(got) == 7 and all(by[i]["lang_pred"] == "und" and by[i]["score"] == 0 and by[i]["rejected"] for i in (1, 2, 3))
    assert by[4]["rejected"] and by[5]["rejected"] and by[4]["lang_pred"] in SYLLABLES


def test_long_text_is_scored_whole(spark, labelled, monkeypatch):
    model = language_id.fit(labelled)
    rnd = random.Random(3)
    long = text(rnd, "aa", 300) + " " + text(rnd, "cc", 9000)
    whole = list(language_id.scored([long], model))
    monkeypatch.setattr(language_id, "BLOCK", 1000)
    pieces = list(language_id.scored([long, None, long], model))
    assert model.languages[int(whole[0][1].argmin())] == "cc"
    assert pieces[0][0] == whole[0][0] == len(language_id.plain(long)) - language_id.ORDER + 1 and pieces[1][0] == 0
    assert abs(pieces[2][1] - whole[0][1]).max() < 1e-6


class Plain:
    """Interpolated Kneser-Ney over one language's texts, straight from its definition, in plain dicts."""

    def __init__(self, texts):
        self.counts = [{} for _ in range(language_id.ORDER + 1)]
        for line in map(language_id.plain, texts):
            for i in range(len(line) - language_id.ORDER + 1):
                gram = line[i : i + language_id.ORDER]
                self.counts[-1][gram] = self.counts[-1].get(gram, 0) + 1
        for order in range(language_id.ORDER - 1, 0, -1):  # in how many ways an n-gram continues another character
            for gram in self.counts[order + 1]:
                self.counts[order][gram[1:]] = self.counts[order].get(gram[1:], 0) + 1
        self.followed = [{} for _ in self.counts]
        for order in range(1, language_id.ORDER + 1):
            for gram, n in self.counts[order].items():
                total, kinds = self.followed[order].get(gram[:-1], (0, 0))
                self.followed[order][gram[:-1]] = (total + n, kinds + 1)

    def probability(self, gram):
        if not gram:
            return 1 / (len(self.counts[1]) + 1)
        total, kinds = self.followed[len(gram)].get(gram[:-1], (0, 0))
        if not total:
            return self.probability(gram[1:])
        n = self.counts[len(gram)].get(gram, 0)
        return max(n - language_id.DISCOUNT, 0) / total + language_id.DISCOUNT * kinds / total * self.probability(gram[1:])

    def scores(self, line):
        return [math.log(self.probability(line[i - language_id.ORDER + 1 : i + 1])) for i in range(language_id.ORDER - 1, len(line))]


def models(texts):
    """The model of the operator and plain ones, from the same texts per language."""
    counts = {}
    for lang, given in texts.items():
        lines = map(language_id.plain, given)
        counts[lang] = dict(Counter(line[i : i + language_id.ORDER] for line in lines for i in range(len(line) - language_id.ORDER + 1)))
    return language_id.build(counts), {lang: Plain(given) for lang, given in texts.items()}


def test_every_character_scores_as_defined():
    rnd = random.Random(6)
    model, plain = models({lang: [text(rnd, lang, 40) for _ in range(5)] for lang in SYLLABLES})
    for line in [text(rnd, "aa", 50), text(rnd, "bb", 50), "zq ж unknown letters", "ka", "漢字"]:
        line = language_id.plain(line)
        found = model.char_scores(language_id.codes_of(line))[language_id.ORDER - 1 :]
        for place, lang in enumerate(model.languages):
            assert found[:, place].tolist() == pytest.approx(plain[lang].scores(line), abs=1e-4)


def test_probabilities_sum_to_one():
    model, plain = models({"aa": ["abca bcab abcb"], "bb": ["aaaa baaa"]})
    for context in ["abc", "  a", "zzz", "aaa"]:
        for place, lang in enumerate(model.languages):
            letters = [*plain[lang].counts[1], "z"]  # one unknown letter has the share of all
            each = [model.char_scores(language_id.codes_of(context + c))[-1][place] for c in letters]
            assert sum(map(math.exp, each)) == pytest.approx(1.0, abs=1e-5)


def test_only_letters_make_a_language(spark, labelled):
    model = language_id.fit(labelled)
    rows = [(1, "½ ² ①"), (2, "Ⅷ ⅻ"), (3, "١٢٣"), (4, "___"), (5, "ª"), (6, "ka2ro")]
    found = {r["doc_id"]: r["lang_pred"] for r in language_id.identify(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    assert all(found[doc] == "und" for doc in (1, 2, 3, 4)) and "und" not in (found[5], found[6])


def test_short_texts_calibrate_and_languages_without_any_take_common_limits(spark):
    rnd = random.Random(5)
    rows = [(i, text(rnd, lang, 6), lang) for i in range(300) for lang in ("aa", "bb")] + [(10_000, text(rnd, "cc", 8), "cc")]
    model = language_id.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert {"aa", "bb", None} <= set(model.limits) and all(language_id.limit(model, lang, 30) < 100 for lang in model.languages)
    odd = [(1, "漢字仮名交じり文漢字仮名"), (2, text(rnd, "aa", 5)), (3, text(rnd, "bb", 5))]
    found = {r["doc_id"]: r["rejected"] for r in language_id.identify(spark.createDataFrame(odd, "doc_id long, text string"), model).collect()}
    assert found == {1: True, 2: False, 3: False}
    one = language_id.fit(spark.createDataFrame([(1, text(rnd, "aa", 30), "aa"), (3, text(rnd, "aa", 30), "aa")], "doc_id long, text string, lang string"))
    assert not one.languages or None in one.limits


def test_query_against_plain_models(spark):
    folder = "/root/testdata/sf0.001"
    df = QUERIES["op7_language_id"](spark, folder)
    assert {("doc_id", "bigint"), ("held_out", "boolean"), ("lang_pred", "string"), ("score", "double")} <= set(df.dtypes)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    learned = docs.filter(~language_id.is_held_out()).filter("lang IS NOT NULL AND text IS NOT NULL AND pmod(xxhash64(doc_id, 'calibrate'), 5) <> 0")
    by = {}
    for r in learned.collect():
        by.setdefault(r["lang"], []).append(r["text"])
    plain = {lang: Plain(texts) for lang, texts in by.items()}
    found = {r["doc_id"]: r for r in df.collect()}
    given = docs.collect()
    assert len(found) == len(given)
    for r in given:
        assert found[r["doc_id"]]["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        line = language_id.plain(r["text"])
        if line and len(line) < 1500:
            entropy = {lang: -sum(model.scores(line)) / (len(line) - language_id.ORDER + 1) for lang, model in plain.items()}
            assert found[r["doc_id"]]["lang_pred"] == min(sorted(entropy), key=entropy.get)
            least, n = min(entropy.values()), min(len(line) - language_id.ORDER + 1, language_id.EVIDENCE)
            score = 1 / sum(math.exp(-(h - least) * n) for h in entropy.values())
            assert found[r["doc_id"]]["score"] == pytest.approx(score, abs=1e-3)


def test_nothing_to_learn_from(spark, labelled):
    model = language_id.fit(labelled.limit(0))
    found = language_id.identify(labelled, model).collect()
    assert {r["lang_pred"] for r in found} == {"und"} and {r["doc_id"] for r in found if r["rejected"]} == {1001}
    assert language_id.identify(labelled.limit(0), language_id.fit(labelled)).count() == 0
