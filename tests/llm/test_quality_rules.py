"""Line rules against plain counting (the whole query is also held against SQL)."""
import re
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from meterflow.llm import quality_rules as q

WORD = re.compile("[^\x20\x09-\x0d]+")


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab #|A!é\n \t\x1c\x85.", max_size=120))
def test_base_counts(text):
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = Counter(zip(w, w[1:], w[2:]))
    inside = {i + d for i in range(len(w) - 2) if windows[tuple(w[i:i + 3])] > 1 for d in range(3)}
    clean, (n, chars, symbols, dup, repeat, n_lines, removed, lost, base, kept) = q.judge(text)
    assert (n, chars, symbols, repeat) == (len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(inside))
    assert (dup, n_lines) == (len(lines) - len(set(lines)), len(lines))
    bad = [x for x in lines if q.failed_rule(x.encode(), len(WORD.findall(x)))]
    assert (removed, lost) == (len(bad), sum(len(WORD.findall(x)) for x in bad))
    assert base == (len(w) < 50 or 100 * len(inside) > 50 * len(w)) and kept == (not base and 2 * lost <= len(w))
    assert len(clean.split("\n")) == len(text.split("\n")) - removed or removed == len(text.split("\n"))


def test_rules_name_what_they_see():
    for line, rule in [("Plain words stand here, as they should.", None), ("OF!! THE!! AND!! MORE!!", "punctuation"), ("a*** b%%% c$$$", "punctuation"),
                       ("Home News Contact", "navigation"), ("one | two | three | four five six seven eight nine ten", "navigation"),
                       ("We use a cookie to make this site work for you.", "boilerplate"), ("All rights reserved.", "boilerplate"), ("End here.", None)]:
        assert q.failed_rule(line.encode(), len(line.split())) == rule, line


def test_edges(spark):
    good = "\n".join(" ".join(f"word{i}x{j}" for j in range(12)) + "." for i in range(9))
    df = spark.createDataFrame([(1, good), (2, None), (3, ""), (1, good), (None, good + "\nMenu Home"), (5, "same " * 20000)], "doc_id long, text string")
    df = df.selectExpr("*", "7 as kept", "'x' as n_words")
    rows = q.line_rules(df).collect()
    assert len(rows) == 6 and rows[0].kept and rows[0].text == good and rows[0] == rows[3]
    assert rows[1].text is None and rows[1].base_failed and not rows[1].kept and rows[2].n_words == 0
    assert rows[4].text == good and rows[4].n_removed_lines == 1
    assert rows[5].base_failed and rows[5].n_repeat_words == 20000
    assert q.line_rules(df.limit(0)).count() == 0
