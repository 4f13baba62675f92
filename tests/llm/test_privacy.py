import re

import pytest
from pyspark.sql import functions as F

from tests.llm import frames
from tillstar.llm import privacy

TEXT = (
    "Mr. John Smith met Mrs Jones; Anna Kowalski, Анна Иванова and Иван Петров. John Smith left. "
    "Bob.S+x@Mail3.Example.com bob.s+x@mail3.example.com; +1 (456) 555-2186, 25.86.162.211, "
    "4111 1111 1111 1111, 4111111111111111, 123-45-6789"
)
CLEAN = "clean 2024-01-02 text 12345, 27071911, 3.14, v1.2.3.4.5, 4111111111111112 and Will or Mark it."


def replaced(spark, rows, key="k"):
    return privacy.replace(frames.docs(spark, rows), key)


def test_types_format_gender_script_and_coreference(spark):
    rows = frames.by_id(replaced(spark, [(1, TEXT), (2, "ask John Smith at bob.s+x@mail3.example.com"), (3, CLEAN)]), "text", "n_entities")
    text, n = rows[1]
    # The same name with and without its title is one person.
    assert n == 13 and rows[3] == (CLEAN, 0)
    for secret in re.findall(r"\w{4,}", "John Smith Jones Kowalski Иванова Петров Mail3"):
        assert secret.lower() not in text.lower()
    first = re.match(r"Mr\. (\w+ \w+) met Mrs \w+;", text)
    assert first and text.count(first[1]) == 2 and first[1] in rows[2][0]
    given = {g: {n for (gender, _), names in privacy.GIVEN.items() if gender == g for n in names} for g in "mf"}
    assert first[1].split()[0] in given["m"]
    women = re.search(r"; (\w+) \w+, (\w+) \w+ and (\w+) \w+\.", text)
    assert women[1] in given["f"] and women[2] in given["f"] and women[3] in given["m"]
    assert re.fullmatch("[а-яА-ЯёЁ]+", women[2])
    mails = re.findall(r"\S+@[\w.]+com", text)
    assert re.fullmatch(r"[A-Z][a-z]{2}\.[A-Z]\+[a-z]@[A-Z][a-z]{3}\d\.[A-Z][a-z]{6}\.com", mails[0])
    assert mails[0].lower() == mails[1] and mails[1] in rows[2][0]
    assert re.search(r"\+1 \(\d{3}\) \d{3}-\d{4}, \d+\.\d+\.\d+\.\d+, ", text)
    cards = re.findall(r"\d{4} \d{4} \d{4} \d{4}|\d{16}", text)
    assert cards[0].replace(" ", "") == cards[1] and cards[1][0] == "4"
    assert spark.range(1).select(privacy.is_card(F.lit(cards[1]))).first()[0]


def test_key_decides(spark):
    a, b = (frames.by_id(replaced(spark, [(1, TEXT)], key), "text")[1] for key in ("k", "other"))
    assert a != b and a == frames.by_id(replaced(spark, [(1, TEXT)]), "text")[1]


def test_distinct_entities_stay_distinct(spark):
    """More persons than names, and all addresses of a small range."""
    people = [f"Peter {chr(65 + i // 26 % 26)}{chr(97 + i % 26)}{'ab'[i // 676]}x" for i in range(900)]
    rows = [(i, f"so {name} said") for i, name in enumerate(people)]
    rows += [(2000 + i, f"at 10.0.{i % 4}.{i // 4} now") for i in range(400)]
    found = frames.by_id(replaced(spark, rows), "text")
    names = [found[i][0][3:-5] for i in range(900)]
    assert len(set(names)) == 900 and not set(names) & set(people)
    hosts = {found[2000 + i][0] for i in range(400)}
    assert len(hosts) == 400


def test_surrogate_is_no_entity_of_the_corpus(spark):
    first = frames.by_id(replaced(spark, [(1, "Peter Xyzabc")]), "text")[1][0]
    found = frames.by_id(replaced(spark, [(1, "Peter Xyzabc"), (2, f"so {first} it is")]), "text")
    assert found[1][0] != first and first not in found[2][0]


def test_few_surrogates_of_a_format(spark):
    """One-letter addresses of a domain are more than the letters that stand for one."""
    mails = [f"{chr(97 + i)}@x.com" for i in range(26)]
    found = frames.by_id(replaced(spark, [(i, f"to {m} now") for i, m in enumerate(mails)]), "text")
    made = [found[i][0][3:-4] for i in range(26)]
    assert len(set(made)) == 26 and not set(made) & set(mails)
    assert all(re.fullmatch(r"[a-z]+@[a-z]\.com", m) for m in made)


def test_words_of_a_name_stay_one_person(spark):
    rows = [
        (1, "John Smith came. Mr. Smith left, then JOHN SMITH and Smith; smith is a trade."),
        (2, "Mrs. Zelda Kowalski spoke. Later Zelda Kowalski left."),
        (3, "Smith without a name stays"),
    ]
    found = frames.by_id(replaced(spark, rows), "text")
    text = re.fullmatch(r"(\w+) (\w+) came\. Mr\. (\w+) left, then (\w+) (\w+) and (\w+); smith is a trade\.", found[1][0])
    given, family = text[1], text[2]
    assert given in privacy.GIVEN["m", "latin"] and given != "John" and family != "Smith"
    assert text.groups()[2:] == (family, given.upper(), family.upper(), family)
    zelda = re.fullmatch(r"Mrs\. (\w+a \w+) spoke\. Later (\w+ \w+) left\.", found[2][0])
    assert zelda[1] == zelda[2] and "Kowalski" not in zelda[1]
    assert found[3][0] == rows[2][1]


def test_given_names_change_in_pairs(spark):
    listed = [(name, group) for group, names in privacy.GIVEN.items() for name in names]
    names = spark.createDataFrame([(name,) for name, _ in listed], "name string")
    made = dict(map(tuple, names.select("name", privacy._other_given(F.col("name"), "k")).collect()))
    assert len(set(made.values())) == len(listed)
    for name, group in listed:
        assert made[name] != name and made[name] in privacy.GIVEN[group]


def test_too_few_surrogates_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(privacy, "MAX_ATTEMPTS", 1)
    with pytest.raises(ValueError, match="email"):
        replaced(spark, [(i, f"{chr(97 + i)}@x.com") for i in range(26)]).count()


def test_awkward_texts_and_columns(spark):
    docs = frames.docs(spark, frames.AWKWARD)
    out = privacy.replace(docs, "k")
    assert out.columns == [*docs.columns, "n_entities", "entities"]
    assert out.select(docs.columns).exceptAll(docs).isEmpty() and out.count() == docs.count()
    assert replaced(spark, []).count() == 0
    twice = replaced(spark, [(1, TEXT), (1, TEXT), (None, TEXT)])
    assert len({r.text for r in twice.collect()}) == 1 and twice.count() == 3


def test_no_python_in_the_plan(spark):
    plan = replaced(spark, [(1, TEXT)])._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|MapInArrow", plan)
