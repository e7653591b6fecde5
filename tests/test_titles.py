import json
import random
import re

import pytest
from pyspark.sql import functions as F

from conftest import rows
from ledgerline.plans import titles
from ledgerline.sources.tables import load_category_map, load_noun_list

BOOK = [
    ("근로계약서", "고용", "근로계약"),
    ("근로", "고용", "기타고용"),
    ("임대", "부동산", "임대차"),
    ("계약", None, None),
    ("비밀유지", "서비스", "보안"),
]
TITLES = [
    ("d1", "  2024 근로계약서 (임대)  ", ["근로계약서", "임대"], "고용", "근로계약"),
    ("d2", "계약 임대 근로", ["계약", "임대", "근로"], "부동산", "임대차"),
    ("d3", "계약만", ["계약"], "기타", "기타"),
    ("d4", "no noun at all", [], "기타", "기타"),
    ("d5", None, [], "기타", "기타"),
    ("d6", "　비밀유지 ", ["비밀유지"], "서비스", "보안"),
    ("d7", "", [], "기타", "기타"),
]


@pytest.fixture()
def dictionary(spark):
    return spark.createDataFrame(BOOK, "noun string, category1 string, category2 string")


@pytest.fixture()
def documents(spark):
    data = [(i, "u", "w", title, "e") for i, title, *_ in TITLES] + [("", "u", "w", "임대", "e"), (None, "u", "w", "임대", "e")]
    df = spark.createDataFrame(data, "documentid string, userid string, workspaceid string, title string, estimated_workspaceid string")
    return df.withColumn("createdat", F.lit("2024-01-01").cast("timestamp_ntz"))


def expected():
    return sorted((i, c1, c2, nouns) for i, _, nouns, c1, c2 in TITLES)


def found(df):
    return sorted((r["documentid"], r["category1"], r["category2"], list(r["nouns"])) for r in df.collect())


def test_contract_categories(documents, dictionary):
    df = titles.contract_categories(documents, dictionary, "documentid")
    assert found(df) == expected()
    assert df.columns == [*titles.DOCUMENT, "nouns", "category1", "category2"]


def test_repeated_nouns_are_settled(documents, dictionary):
    twice = dictionary.unionByName(dictionary)
    assert found(titles.contract_categories(documents, twice, "documentid")) == expected()


@pytest.mark.parametrize("whole", [False, True])
def test_classify_against_a_pattern(spark, whole):
    draw = random.Random(4)
    nouns = ["ring", "spring", "ringer", "a", "ab", "aba", "bab", "in", "b"]
    data = [(f"k{i}", "".join(draw.choice("ab ring sp,") for _ in range(draw.randrange(60)))) for i in range(300)]
    data += [("long", "spring ring ab " * 3000), ("bring", "bring it")]
    book = spark.createDataFrame([(n, n.upper() if len(n) > 1 else None) for n in nouns], "noun string, category1 string")
    rows_ = titles.classify(spark.createDataFrame(data, "documentid string, title string"), book, ["category1"], "documentid", whole)
    either = "|".join(sorted(nouns, key=lambda n: -len(n)))
    pattern = re.compile(rf"(?<![a-z])(?:{either})(?![a-z])" if whole else either)
    title = dict(data)
    for r in rows_.collect():
        want = pattern.findall(title[r.documentid].strip())
        assert list(r.nouns) == want
        assert r.category1 == next((n.upper() for n in want if len(n) > 1), titles.OTHER)


def test_form_categories(documents, dictionary):
    df = titles.form_categories(documents, dictionary, "documentid")
    assert sorted((r["documentid"], r["category1"]) for r in df.collect()) == [(i, c1) for i, c1, _, _ in expected()]
    assert df.columns == [*titles.DOCUMENT, "nouns", "category1"]


def test_empty_dictionary(documents, dictionary):
    for r in titles.form_categories(documents, dictionary.limit(0), "documentid").collect():
        assert (list(r.nouns), r.category1) == ([], titles.OTHER)


def test_whole_words(spark):
    df = spark.createDataFrame([("small ring, spring",)], "title string")
    for whole, want in ((True, ["ring"]), (False, ["ring", "ring"])):
        assert df.select(titles.title_nouns(F.col("title"), ["ring"], whole)).first()[0] == want


def test_dictionary_files(spark, tmp_path):
    nouns, book = tmp_path / "nouns.txt", tmp_path / "book.json"
    nouns.write_text("근로\tNNG\n임대    NNG\n\n임대 NNG\n", encoding="utf-8")
    book.write_text(json.dumps({"근로": "고용", "보험": "금융"}, ensure_ascii=False, indent=2), encoding="utf-8")
    df = titles.noun_dictionary(load_noun_list(spark, str(nouns)), category1=load_category_map(spark, str(book)))
    assert sorted(tuple(r) for r in df.collect()) == [("근로", "고용"), ("임대", None)]


def test_templates_need_a_known_workspace(spark):
    template = spark.createDataFrame(
        [("t1", "w1", "m", "x"), ("t2", "w2", "m", "x"), ("t3", None, "m", "x")], "id string, workspaceid string, memberid string, title string"
    ).withColumn("createdat", F.lit("2024-01-01").cast("timestamp_ntz"))
    test = spark.createDataFrame([("w1",)], "workspaceid string")
    done = spark.createDataFrame([("t2",)], "templateid string")
    assert [r["templateid"] for r in titles.new_templates(template, test, None).collect()] == ["t2"]
    assert titles.new_templates(template, test, done).isEmpty()
