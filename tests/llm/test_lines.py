"""Lines keep their white space, the first and the last as well."""

import brute

from tillworks.llm import quality_rules


def test_first_and_last_lines_are_whole(spark):
    texts = ["a b\r\nc d\r\na b\r\n", "foo\nfoo ", " foo\nfoo", "\tx\ny\n\tx", "foo \nfoo ", "\r\n a\r\n a\r\n\r\n", "\n", "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in quality_rules.with_statistics(docs, "text", "q").select("doc_id", "q.*").collect()}
    for doc, text in enumerate(texts):
        r = got[doc]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == brute.statistics(text)[:5], text
    assert [got[i]["n_dup_lines"] for i in range(2)] == [1, 0]
