from sundial.llm import secrets


def test_values_with_a_late_digit_or_letter_are_linked(spark):
    texts = [f"login=bob {v}" for v in ("k" * 250 + "7", "7/" * 125 + "k", "k" * 250, "7/" * 125, "k" * 18 + "7")]
    got = {r.doc_id: r.spans for r in secrets.report(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert {i for i, s in got.items() if "value:10:261" in s} == {0, 1} and not any("value" in got[i] for i in (2, 3, 4))
