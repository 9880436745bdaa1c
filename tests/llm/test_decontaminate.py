import re

import pytest

from tallyframe.llm import decontaminate as dc
from tallyframe.llm.queries import LLM_QUERIES

QUESTION = (
    "Maria buys 12 apples and 7 pears at the market in Lisbon. She pays 3 dollars for every apple, "
    "and 2 dollars for every pear. How many dollars does Maria pay for the 12 apples?"
)
FILLER = "Here is a sentence about nothing much at all, written to stand around the passage"


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame([(1, QUESTION), (2, None), (3, "Short one."), (4, "Name the capital of this old country, please")], "item_id long, text string")


def judge(spark, bench, *texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.id: r for r in dc.contaminated_documents(dc.contaminated_windows(docs, bench)).collect()}


def test_copies_and_new_parameters(spark, bench):
    renamed = QUESTION.replace("Maria", "Jonas").replace("12", "45").replace("dollars", "euros").replace("Lisbon", "Oslo")
    # In every window of the first sentence the same value is used for two slots.
    mixed = "Maria buys 9 apples and 9 pears at the market in Lisbon."
    found = judge(
        spark, bench,
        f"{FILLER} {QUESTION} {FILLER}", f"{FILLER} {renamed} {FILLER}", f"{FILLER}. {QUESTION.upper()}",
        f"{FILLER}. {QUESTION.lower()}", f"{FILLER} {mixed} {FILLER}", FILLER, "short one", None, "",
        "name the capital of this old country, please", "and then name the capital of this old country, please",
    )
    assert set(found) == {0, 1, 2, 3, 9, 10}
    assert not found[0].reparameterised and found[1].reparameterised
    assert found[1].item_id == 1 and found[9].item_id == 4


def test_runs_of_numbers_do_not_match_each_other(spark):
    bench = spark.createDataFrame([(1, " ".join(str(i * 7) for i in range(30)))], "item_id long, text string")
    found = judge(spark, bench, " ".join(str(i * 11 + 3) for i in range(200)), " ".join(str(i * 7) for i in range(5, 25)))
    assert set(found) == {1}


def test_planted_passages(spark):
    d = "/root/testdata/sf0.01"
    got = {r.doc_id for r in LLM_QUERIES["op10_decontaminate"](spark, d).collect()}
    plain = lambda t: " " + " ".join(re.findall(r"\w+", t.lower())) + " "
    items = [plain(r.text) for r in spark.read.parquet(f"{d}/benchmark.parquet").collect()]
    docs = spark.read.parquet(f"{d}/documents.parquet").collect()
    assert got == {r.doc_id for r in docs if any(x in plain(r.text or "") for x in items)}


def test_a_passage_in_most_documents(spark, bench):
    docs = spark.range(3000).selectExpr("id doc_id", f"concat('{FILLER} ', id, ' {QUESTION}') text")
    windows = dc.contaminated_windows(docs, bench)
    assert dc.contaminated_documents(windows).count() == 3000
    n = len(QUESTION.split()) - dc.WINDOW + 1
    assert windows.count() <= 3000 * 2 * n  # one row per window and form


def test_odd_rows(spark, bench, odd_documents):
    extra = odd_documents.unionByName(spark.createDataFrame([(50, QUESTION, "x", 1), (None, QUESTION, "x", 1)], odd_documents.schema))
    kept = dc.drop_contaminated(extra, bench)
    assert kept.columns == extra.columns and kept.count() == extra.count() - 2  # with and without an id
    assert dc.drop_contaminated(extra, bench.limit(0)).count() == extra.count()
    assert dc.drop_contaminated(extra.limit(0), bench).count() == 0


def test_names_at_the_start_of_sentences(spark):
    question = "Tom has 3 apples. Tom buys 4 pears. Tom sells 2 plums. How many fruits has Tom now?"
    bench = spark.createDataFrame([(1, question), (2, "Tom lent his old green bicycle to a friend")], "item_id long, text string")
    found = judge(spark, bench, question.replace("Tom", "Ann"), "Ann lent his old green bicycle to a friend", "Ann sold his old green bicycle to a friend")
    assert set(found) == {0, 1}


def test_runs_of_names_and_numbers_are_one_slot(spark):
    question = "The train from New York to the coast carries twenty five people and stops at three small stations"
    bench = spark.createDataFrame([(1, question)], "item_id long, text string")
    found = judge(spark, bench, question.replace("New York", "Oslo").replace("twenty five", "30"))
    assert set(found) == {0}


def test_short_items_and_scripts_without_spaces(spark):
    items = [
        (1, "Who wrote it?"), (2, "Yes."), (3, "小明有三个苹果，小红有五个，一共有多少个苹果？"), (4, "四加五是？"), (5, "ราคาเท่าไร"), (6, ""), (7, None),
    ]
    docs = [
        (10, "We asked again. Who wrote it? Nobody knew."), (11, "I know who wrote it and why."), (12, "yes"), (13, "Yes. And then we left."),
        (14, "题目：小明有三个苹果，小红有五个，一共有多少个苹果？答案是八个。"), (15, "小明有两个梨。"), (16, "Quiz. 四加五是？ The end."), (17, "四加五是九"),
        (18, "who wrote it"), (19, None), (20, "ราคาเท่าไร"),
    ]
    found = dc.contaminated_documents(
        dc.contaminated_windows(spark.createDataFrame(docs, "doc_id int, text string"), spark.createDataFrame(items, "item_id int, text string"))
    )
    assert {r.id: r.item_id for r in found.collect()} == {10: 1, 14: 3, 16: 4, 18: 1, 20: 5}


def test_words_do_not_depend_on_the_memo(monkeypatch):
    texts = [f"Word{i % 37} tom{i}, in 5 km. Anna {i}!" for i in range(400)]
    whole = dc.Words().read(texts)
    monkeypatch.setattr(dc, "MEMO_WORDS", 50)
    words = dc.Words()
    parts = [words.read(texts[i : i + 40]) for i in range(0, 400, 40)]
    for i in range(1, 6):
        assert [*whole[i]] == [x for p in parts for x in p[i]]


def brute_template_hits(docs, items):
    """Windows of 12 words in template form, each compared with each: the
    same literal words, the same kinds of slots, repeated in the same places."""

    def windows(text):
        words = dc.Words()
        _, code, kind, name, _, _ = words.read([text])
        for i in range(len(code) - 11):
            slots, shape = {}, []
            for j in range(i, i + 12):
                slot = "name" if name[j] and j > i else {dc._NUM: "number", dc._UNIT: "unit"}.get(int(kind[j]))
                shape.append((slot, slots.setdefault(int(code[j]), len(slots))) if slot else int(code[j]))
            # Only a template if half of its words are literal.
            if sum((kind[i : i + 12] != dc._LITERAL) | name[i : i + 12]) <= 6:
                yield tuple(shape)

    asked = {w: k for k, t in items.items() for w in windows(t)}
    return {d for d, t in docs.items() if any(w in asked for w in windows(t))}


def test_renamed_questions_equal_brute_force(spark):
    import random

    rng = random.Random(9)
    names, nouns = ["Tom", "Ann", "Bob", "Eve"], ["apples", "pears", "plums", "nuts"]

    def question(consistent=True):
        a, b = rng.sample(names, 2)
        n, c = rng.randrange(2, 90), a if consistent else b
        return f"In the shop {a} has {n} {rng.choice(nouns)} and then gives {n if consistent else n + 1} of them to {b} before {c} goes home"

    items = {i: question() for i in range(6)}
    docs = {100 + i: f"A text that says this. {question(i % 3 > 0)}. And it ends." for i in range(40)}
    docs |= {200 + i: " ".join(rng.choices(["the", "shop", "Tom", "12", "km", "and", "home"], k=30)) for i in range(10)}
    want = brute_template_hits(docs, items)
    assert 5 < len(want) < 40
    windows = dc.contaminated_windows(
        spark.createDataFrame(list(docs.items()), "doc_id int, text string"), spark.createDataFrame(list(items.items()), "item_id int, text string")
    )
    got = {r.id for r in windows.select("id").distinct().collect()}
    # The literal and the wide form find more, never less.
    assert want <= got and all(d < 200 for d in got)


def test_texts_under_one_id_are_judged_each(spark, bench):
    docs = spark.createDataFrame([(1, QUESTION), (1, FILLER), (None, QUESTION), (None, FILLER), (None, None)], "doc_id long, text string")
    kept = dc.drop_contaminated(docs, bench).collect()
    assert sorted(((r.doc_id, r.text) for r in kept), key=repr) == sorted([(1, FILLER), (None, FILLER), (None, None)], key=repr)
