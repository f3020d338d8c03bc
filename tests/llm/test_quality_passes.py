"""The quality rules walk a text's words once; counts equal plain Python on odd texts."""

import re

from tessera.llm import op5_quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = [None, "", " \n\t", "a", " x İi #|<>&%$*# \U0001f600 b", "A  b\x0b\x0cc\r\na b c\n a B\tC \n\n",
         "one two three four five six\none two three four five", "　\n\x85 x\n" * 3, "(a) [b] \\ ^ $1 %s"]


def test_counts_on_odd_texts(spark):
    docs = spark.createDataFrame([(i, t, "s") for i, t in enumerate(TEXTS)], "doc_id long, text string, source string")
    for r in op5_quality.measure(docs).collect():
        text = r.text or ""
        words = WORD.findall(text)
        lines = [x for x in text.split("\n") if WORD.search(x)]
        assert (r.n_words, r.word_chars) == (len(words), sum(map(len, words)))
        assert r.n_symbols == len(re.findall(r"[#*$%&|<>]", text))
        assert r.n_dup_lines == len(lines) - len(set(lines))
        assert [x.n for x in r.lines] == [len(WORD.findall(x)) for x in lines]
    hashes = {r.doc_id: [x.h for x in r.lines] for r in op5_quality.measure(docs).collect()}
    assert len(set(hashes[5])) == 1 and len(hashes[5]) == 3


def test_words_are_found_once(spark):
    docs = spark.createDataFrame([(1, "a b", "s")], "doc_id long, text string, source string")
    plan = op5_quality.measure(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("[^\\x20\\x09-\\x0D]+") == 1        # before: for the count, the words and those of each line
