"""Overlapping spans are redacted whole."""

from shoplens.llm import pii_votes


def test_what_sticks_out_of_a_span_is_redacted(spark):
    texts = {"+1 555 123 4567jane.doe@web.de": "<PHONE><EMAIL>",
             "call +1 555 123 4567-jane.doe@web.de now": "call <PHONE><EMAIL> now",
             "card 4111 1111 1111 1111.bob@mail.example.com": "card <CARD><EMAIL>",
             "a@b.example.com or +1 (521) 555-6210.": "<EMAIL> or <PHONE>.",
             "no span here": "no span here"}
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.text for r in pii_votes.redact(docs).collect()}
    assert [got[i] for i in range(len(texts))] == list(texts.values())
