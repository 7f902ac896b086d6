"""Copies of benchmark items with edits that shift words, and items that are mostly numbers."""

from __future__ import annotations

import pytest

from riskframe.llm import decontam

SHORT = "the quick fox runs over green hills while seven old owls watch from trees near our quiet village pond"
MIDDLE = f"{SHORT} and nobody knows why they never sleep when summer rain falls on dusty roads behind the mill"
NAMED = "Yesterday we took the train from New York to Boston where old Mary Ann Lee sold 12 kg of apples at the market"
SUM = "What is the sum of 13, 27, 45 and 62?"
SHARES = "Compute 15 percent of 240 dollars plus 20 percent of 60 dollars"


def found(spark, items, cases):
    items = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    docs = spark.createDataFrame(list(cases.items()), "doc_id long, text string")
    return {(r.doc_id, r.item_id): r for r in decontam.matches(docs, items).collect()}


def test_inserted_and_dropped_words_and_names_of_other_length(spark):
    def edit(text, at, put, drop=0):
        words = text.split()
        return "So they say: " + " ".join([*words[:at], *put, *words[at + drop :]]) + " indeed it is so."

    cases = {
        1: edit(SHORT, 9, ["very"]),
        2: edit(SHORT, 9, [], 1),
        3: edit(MIDDLE, 18, ["just"]),
        4: edit(MIDDLE, 18, [], 1),
        5: "They say: " + NAMED.replace("New York", "Paris").replace("Mary Ann Lee", "Tom"),
        6: "They say: " + NAMED.replace("Boston", "Los Angeles").replace("12 kg", "12"),
        7: "They say: " + " ".join(SHORT.split()[:9]) + " and then a wholly different story follows here",
    }
    got = found(spark, [SHORT, MIDDLE, NAMED], cases)
    assert {(1, 0), (2, 0), (3, 1), (4, 1), (5, 2), (6, 2)} <= set(got)
    assert not [d for d, _ in got if d == 7]
    assert got[1, 0].changed == 0 and got[5, 2].changed > 0


def test_slots_stay_consistent_across_an_edit(spark):
    text = "Add 5 and 5 then take the sum of both and write it down then add 5 and 7 and say it in words"
    docs = {1: text.replace("5", "8").replace("write it", "write all it"), 2: text.replace("5", "8", 2).replace("write it", "write all it")}
    assert {d for d, _ in found(spark, [text], docs)} == {1}


def test_items_of_few_plain_words_are_found_verbatim_only(spark):
    cases = {
        1: f"Here is a task. {SUM} Write it down.",
        2: f"Here is a task. {SHARES} and so on.",
        3: "Here is a task. What is the sum of 14, 28, 46 and 63? Write it down.",
        4: "He said yes and no to it.",
    }
    with pytest.warns(UserWarning, match="1 benchmark items"):
        got = found(spark, [SUM, SHARES, "yes and no"], cases)
    assert set(got) == {(1, 0), (2, 1)}
    items = spark.createDataFrame([(1, "yes and no"), (2, SUM), (3, None)], "item_id long, text string")
    assert [tuple(r) for r in decontam.short_items(items).collect()] == [(1, 3)]
