import re
import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from jobstrata import config
from jobstrata.functions import patterns, text
from jobstrata.operators import relevance


def values(spark, items, make, schema="id int, v string"):
    rows = list(enumerate(items))
    df = spark.createDataFrame(rows, schema).select("id", make(F.col("v")).alias("out"))
    return [r["out"] for r in sorted(df.collect(), key=lambda r: r["id"])]


def test_relevance_defaults(spark):
    titles = ["Data Analyst", "Senior Data Engineer, Backend", "Marketing", "DỮ LIỆU - KHOA HỌC", "VNPTDataEngineer",
              "CakeDataEngineer", "", None, "Chuyên viên phân tích dữ liệu - Quản trị"]
    df = spark.createDataFrame(list(enumerate(titles)), "id int, job_title string")
    kept = {r.id for r in relevance.keep_relevant(df).collect()}
    assert kept == {0, 3, 5, 8}


def test_word_edges_follow_the_unicode_definition(spark):
    titles = ["AI", "ộAI", "AI²", "x²AI", "½AI", "_AI", "AI-x", "(ai)", "ế AI", "éai", "AIs", "aí", "ﬁai"]
    got = values(spark, titles, lambda c: c.rlike(patterns.whole_word(["ai"])))
    want = [bool(re.search(r"\b(ai)\b", t, re.IGNORECASE)) for t in titles]
    assert got == want


def test_title_rules(spark):
    titles = ["Data Scientist / Data Engineer", "Chuyên viên Quản Lý Dữ Liệu", "Database Administrator", "Chef", None,
              "Senior DATA ANALYST", "AI Developer"]
    assert values(spark, titles, text.rule_label) == [
        "Data Scientist", "Data Engineer", "Data Engineer", None, None, "Data Analyst", "Data Scientist"]


@pytest.mark.parametrize("edges_only", [False, True])
def test_skills(spark, edges_only):
    jd = "python, Python; C++11; C++ dev; Power BI"
    got = values(spark, [jd, None, "", "None"], lambda c: text.extract_terms(c, edges_only=edges_only))
    assert got == [["C++", "Power BI", "Python", "python"], [], [], []]


def test_symbol_skills_need_an_edge_only_on_request(spark):
    assert values(spark, ["C++ dev"], text.extract_terms) == [["C++"]]
    assert values(spark, ["C++ dev"], lambda c: text.extract_terms(c, edges_only=True)) == [[]]


def test_longer_terms_win(spark):
    assert values(spark, ["Apache Spark, Microsoft SQL Server"], text.extract_terms) == [
        ["Apache Spark", "Microsoft SQL Server"]]


def test_accent_letters_cover_the_alphabet():
    accented, plain = text.vietnamese_letters()
    assert len(accented) == len(plain) == 134 == len(set(accented))
    for a, p in zip(accented, plain):
        assert p == "dD"["đĐ".index(a)] if a in "đĐ" else unicodedata.normalize("NFD", a)[0] == p


def test_accents_and_places(spark):
    assert values(spark, ["Đắk Lắk", None, "  Thừa Thiên Huế\t"], text.remove_accents) == ["Dak Lak", "", "Thua Thien Hue"]
    got = values(spark, ["Hà Nội, HaNoi, Hà Nội", "Paris", "", None, "TP. HỒ CHÍ MINH; Đà Nẵng"], text.normalise_location)
    assert got == ["Ha Noi, HaNoi", "Other", "Other", "Other", "HO CHI MINH, Da Nang"]


def test_place_lists(spark):
    df = spark.createDataFrame([(["Hà Nội", "Cần Thơ"],), ([],), (None,)], "v array<string>")
    got = [r[0] for r in df.select(text.normalise_location(text.join_places(F.col("v")))).collect()]
    assert got == ["Ha Noi, Can Tho", "Other", "Other"]


def test_default_roles(spark):
    titles = {"AI Engineer": "Data Scientist", "Head of AI": "Other Data Job", "Data Architect": "Data Engineer",
              "SQL Developer": "Data Engineer", "BI Developer": "Data Analyst", "Business Analyst": "None",
              "Business Analyst (SQL, Tableau)": "Data Analyst", "Data Governance Specialist": "Other Data Job",
              "Data Quality Coordinator": "Other Data Job", "Full stack developer": "None",
              "Kỹ sư thị giác máy tính": "Data Scientist", "Data Manager": "Other Data Job", "NLP Researcher": "Data Scientist"}
    assert dict(zip(titles, values(spark, list(titles), text.role_by_title))) == titles


def test_literal_lists(spark):
    got = values(spark, ["['a', \"b's\"]", "[broken", "plain", None, "[]"], text.parse_literal_list)
    assert got == [["a", "b's"], [], ["plain"], None, []]


def test_tags(spark):
    df = spark.createDataFrame([(["SQL", "+2"], "Python , SQL,+9"), (["R"], ""), (None, None)], "a array<string>, b string")
    assert [r[0] for r in df.select(text.merge_tags(F.col("a"), F.col("b"))).collect()] == [["Python", "SQL"], ["R"], []]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="aiAI _²é-ộ9", max_size=12), min_size=1, max_size=20))
def test_whole_word_matches_python(spark, items):
    got = values(spark, items, lambda c: c.rlike(patterns.whole_word(["ai", "a", "9"])))
    assert got == [bool(re.search(r"\b(ai|a|9)\b", t, re.IGNORECASE)) for t in items]


def test_every_keyword_is_kept_literally():
    assert len(config.SKILLS) == len(set(config.SKILLS))
    with pytest.raises(ValueError):
        patterns.alternation([])


def test_words_in_camel_case_are_found_as_if_it_were_split(spark):
    import random

    from jobstrata.functions import patterns

    words = ["data", "data engineer", "powerbi", "power bi", "c++", "r", "dữ liệu", ".net", "a b"]
    dice = random.Random(1)
    pieces = ["Data", "data", "Engineer", "engineer", "Power", "BI", "bi", "Bi", "C++", "R", "r", "DỮ LIỆU", "dữ Liệu", ".NET", " ",
              " ", "x", "A", "b", "B", "é", "_", "1", "\n", "aB", "A B", "A  B"]
    texts = ["".join(dice.choice(pieces) for _ in range(dice.randint(1, 6))) for _ in range(3000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for some in (words, ["data engineer", "power bi"], ["r"], ["c++", ".net"]):
        direct = F.col("t").rlike(patterns.whole_word(some, camel=True))
        split = text.split_camel_case(F.col("t")).rlike(patterns.whole_word(some))
        assert df.filter(direct != split).collect() == []
        assert 0 < df.filter(direct).count() < 3000
