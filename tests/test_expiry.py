"""Shelf lives of several sentences and of spoiled text."""

import pytest

from provlake.operators import publish

CASES = {
    "제조일로부터 12개월. 개봉 후 3일 이내 섭취": [(12.0, "MONTH", "MANUFACTURE", None), (3.0, "DAY", "OPENING", None)],
    "냉장 보관하세요!\n수령 후 1.5 weeks; packed 10 days": [(None, None, None, "REFRIGERATED"), (1.5, "WEEK", "RECEIPT", None), (10.0, "DAY", "PACKAGING", None)],
    "<p>제 조 일로부터 3O일</p><li>냉동</li>": [(30.0, "DAY", "UNKNOWN", None), (None, None, None, "FROZEN")],
    "제 조 일 로부터 l2개월 (실온)": [(12.0, "MONTH", "MANUFACTURE", "ROOM")],
    "제조 후 ２４시간": [(24.0, "HOUR", "MANUFACTURE", None)], "1 . 5 days after opening. Keep frozen.": [(1.5, "DAY", "OPENING", None), (None, None, None, "FROZEN")],
    "nothing here. at all": [], "": [], "Oil and lO ideas": [],
}


@pytest.mark.parametrize("text", list(CASES))
def test_sentences(spark, text):
    df = spark.createDataFrame([(text,)], "t string")
    assert [tuple(e) for e in df.select(publish.expiration_sentences("t")).first()[0]] == CASES[text]


def test_choice(spark):
    texts = ["개봉 후 3일. 제조일로부터 12개월. 냉장", "3일. 5일", "제조 3일. 제조 4일", None, "제조 3일. 제조 3일. 냉동"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: tuple(r.c) for r in df.select("i", publish.expiration_choice("t").alias("c")).collect()}
    assert got == {
        0: (12.0, "MONTH", "MANUFACTURE", "REFRIGERATED", False), 1: (3.0, "DAY", "UNKNOWN", None, True), 2: (3.0, "DAY", "MANUFACTURE", None, True),
        3: (None, None, None, None, False), 4: (3.0, "DAY", "MANUFACTURE", "FROZEN", False),
    }
