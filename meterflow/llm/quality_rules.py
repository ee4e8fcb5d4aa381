"""Line-first cleaning (operator 5).

Every line of a text is judged by punctuation, navigation and boilerplate
rules; failing lines go; a document that loses more than half of its words is
rejected, as is one that fails the rules on the whole text. A word is
``[^\\x20\\x09-\\x0D]+``, a line is what stands between line feeds.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from meterflow.llm.scratch import bounded_batches
from meterflow.llm.texts import slices

SYMBOLS = b"#*$%&|<>"
UPPER, LOWER = bytes(range(65, 91)), bytes(range(97, 123))
ENDS = b".!?:;,\"')]"
PHRASES = ("cookie", "javascript", "newsletter", "subscribe", "sign in", "log in", "all rights reserved", "terms of use",
           "terms of service", "privacy policy", "click here", "read more", "licensed under", "under the mit license")
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_removed_lines", "removed_words")
FLAGS = ("base_failed", "kept")


def failed_rule(line: bytes, words: int) -> str | None:
    """The rule that a line with ``words`` words (at least one) fails.

    punctuation: symbols for more than 3 in 10 words, ! or ? for more than half
    of them, or over 60 % capitals among ten ASCII letters or more;
    navigation: three bars or more, or at most three words without an end mark;
    boilerplate: a stock phrase.
    """
    symbols = sum(map(line.count, (b"#", b"*", b"$", b"%", b"&", b"|", b"<", b">")))
    upper, lower = (len(line) - len(line.translate(None, x)) for x in (UPPER, LOWER))
    if 10 * symbols > 3 * words or 2 * (line.count(b"!") + line.count(b"?")) > words or (upper + lower >= 10 and 10 * upper > 6 * (upper + lower)):
        return "punctuation"
    if line.count(b"|") >= 3 or words <= 3 and line.rstrip()[-1] not in ENDS:
        return "navigation"
    low = line.decode().lower()
    return "boilerplate" if any(p in low for p in PHRASES) else None


def repeated_words(words: list) -> int:
    """How many words stand in a window of three that the text holds twice or more."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    count = Counter(windows)
    total, done = 0, 0  # done: the first position not counted yet
    for i, w in enumerate(windows):
        if count[w] > 1:
            total += i + 3 - max(done, i)
            done = i + 3
    return total


def judge(text: str | None) -> tuple[str | None, tuple]:
    """(the text without failing lines, the counts and flags)."""
    if text is None:
        return None, (0,) * len(COUNTS) + (True, False)
    raw = text.encode()
    lines = raw.split(b"\n")
    words, seen, kept_lines = [], set(), []
    dup = n_lines = removed = lost = 0
    for line in lines:
        mine = line.split()
        if mine:
            n_lines += 1
            dup += line in seen
            seen.add(line)
            words += mine
            if failed_rule(line, len(mine)):
                removed += 1
                lost += len(mine)
                continue
        kept_lines.append(line)
    n = len(words)
    chars = sum(map(len, words)) - (len(raw) - len(text))
    repeat = repeated_words(words)
    base = n < 50 or 100 * repeat > 50 * n
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    return b"\n".join(kept_lines).decode(), (n, chars, symbols, dup, repeat, n_lines, removed, lost, base, not base and 2 * lost <= n)


def line_rules(docs: DataFrame) -> DataFrame:
    """``docs`` with ``text`` cleaned of failing lines and the columns of COUNTS and FLAGS.

    Counts are of the text as it came. Null texts stay null, with no words;
    they, empty and blank texts fail the base rules (fewer than 50 words).
    Every row stays, repeated ones too; rejected documents have kept false.
    Other columns pass through; columns named like the added ones are replaced.
    """
    docs = docs.drop(*COUNTS, *FLAGS)
    names = docs.columns
    schema = T.StructType([*docs.schema.fields, *(T.StructField(c, T.LongType()) for c in COUNTS), *(T.StructField(c, T.BooleanType()) for c in FLAGS)])

    def run(batches):
        for part in slices(batches, "text", 8 << 20):
            texts, rows = zip(*map(judge, part.column("text").to_pylist()), strict=True)
            columns = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(texts, pa.string()) if c == "text" else part.column(c) for c in names),
                 *(pa.array(x, pa.int64()) for x in columns[:len(COUNTS)]), *(pa.array(x, pa.bool_()) for x in columns[len(COUNTS):])],
                names=[*names, *COUNTS, *FLAGS])

    return bounded_batches(docs).mapInArrow(run, schema)


_WORD = r"[^\x20\x09-\x0D]+"


def _count(column: str, chars: str) -> str:
    return f"length(regexp_replace({column}, '[^{chars}]', '', 'g'))"


ORACLE_SQL = f"""
WITH raw AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
words AS (SELECT r, u.pos, u.word FROM raw, unnest(regexp_extract_all(text, '{_WORD}')) WITH ORDINALITY AS u(word, pos)),
windows AS (SELECT r, pos, count(*) OVER (PARTITION BY r, a, b, c) AS n FROM (
    SELECT r, pos, word AS a, lead(word) OVER w AS b, lead(word, 2) OVER w AS c FROM words WINDOW w AS (PARTITION BY r ORDER BY pos))
    WHERE c IS NOT NULL),
repeats AS (SELECT r, count(*) AS n FROM (SELECT DISTINCT r, pos + d AS pos FROM windows, (VALUES (0), (1), (2)) AS v(d) WHERE n > 1) GROUP BY r),
lines AS (SELECT r, line, len(regexp_extract_all(line, '{_WORD}')) AS w FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM raw)),
judged AS (SELECT r, line, w,
    10 * {_count('line', '#*$%&|<>')} > 3 * w OR 2 * {_count('line', '!?')} > w
    OR ({_count('line', 'A-Za-z')} >= 10 AND 10 * {_count('line', 'A-Z')} > 6 * {_count('line', 'A-Za-z')})
    OR {_count('line', '|')} >= 3 OR (w <= 3 AND NOT regexp_matches(line, '[.!?:;,"'')\\]][\\x20\\x09-\\x0D]*$'))
    OR {" OR ".join(f"contains(lower(line), '{p}')" for p in PHRASES)} AS bad
    FROM lines WHERE w > 0),
per AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS dup, count(*) FILTER (bad) AS removed,
    coalesce(sum(w) FILTER (bad), 0) AS lost FROM judged GROUP BY r),
counts AS (SELECT raw.doc_id, coalesce(len(regexp_extract_all(text, '{_WORD}')), 0) AS n_words,
    coalesce(length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g')), 0) AS word_chars,
    coalesce({_count('text', '#*$%&|<>')}, 0) AS n_symbols, coalesce(dup, 0) AS n_dup_lines, coalesce(repeats.n, 0) AS n_repeat_words,
    coalesce(n_lines, 0) AS n_lines, coalesce(removed, 0) AS n_removed_lines, coalesce(lost, 0) AS removed_words
    FROM raw LEFT JOIN per USING (r) LEFT JOIN repeats USING (r))
SELECT doc_id, {", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in COUNTS)},
    n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 2 * removed_words <= n_words AS kept
FROM counts
"""
