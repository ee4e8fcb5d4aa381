"""BPE against the tokenizers library on its public vocabulary."""
import random
import sys
from hashlib import sha256

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

P = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")

from meterflow.llm import bpe  # noqa: E402

PATH = P.path("byte_bpe_50k.json")
V = bpe.Vocabulary.load(PATH)
LIB = tokenizers.Tokenizer.from_file(PATH)


def lib(text):
    return LIB.encode(text, add_special_tokens=False).ids


WORDS = ["the", " the", " other", "there", "er", " aaaaaaa", "é", " ñandú", "\n", "  "]
ENCODER = bpe.Encoder(V, bpe.Lexicon(bpe.compile_lexicon([w.encode() for w in WORDS], V.merge([w.encode() for w in WORDS]))))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from("aaaabbeth 's'll \n\t\r\x1c\x85\xa0　1２é漢😀|<>"), st.characters(exclude_categories=["Cs"])), max_size=60), max_size=4))
def test_equals_library(texts):
    ids = ENCODER.encode(texts)
    assert ids == [lib(t) for t in texts]
    assert [V.decode(x) for x in ids] == texts == [LIB.decode(x, skip_special_tokens=False) for x in ids]


def test_every_character_is_classed_as_in_the_library():
    texts = ["".join(f"a{chr(c)}b {chr(c)}1{chr(c)}!" for c in range(b, min(b + 512, 0x110000)) if not 0xD800 <= c < 0xE000)
             for b in range(0, 0x32000, 512)]
    bad = [i for i, (x, t) in enumerate(zip(ENCODER.encode(texts), texts)) if x != lib(t)]
    assert not bad


def test_special_token_long_words_and_blanks():
    for t in ["<|endoftext|>", "a <|endoftext|> b<|endoftext|>", "x" * 5000, "ab" * 300 + " " + "=" * 700, "a" * 199 + " " + "a" * 201,
              " \n \n  word\n\n\nend  ", "a  b", "a   b", "  x", "   x", "a  ", "a ", "x\n  b", "a \n b", "x.\n\n w", "\n", " ", "", "don't we'll I'M it's  'sup", "", "<|endoftext", "漢字" * 400]:
        assert ENCODER.encode([t]) == [lib(t)], t[:40]


def test_heap_and_vector_merging_agree():
    r = random.Random(1)
    words = ["".join(r.choice("aabcdeghin st") for _ in range(r.randrange(1, 40))).encode() for _ in range(500)]
    assert V.merge(words) == [V.merge_one(w) for w in words]


def test_lexicon_is_minimal_and_complete():
    words = [b"tap", b"taps", b"top", b"tops", b"stop", b"stops", b"s"]
    lex = bpe.Lexicon(bpe.compile_lexicon(words, [[i, i + 1] for i in range(len(words))]))
    ranks = lex.find([*words, b"", b"t", b"tapsx", b"q"])
    assert lex.ids_of(ranks[:7]) == [(i, i + 1) for i in range(7)]
    assert ranks[7:].tolist() == [-1] * 4
    assert len(lex.keys) == 8  # all words end in the same p and s edges; stop shares op with top
    assert bpe.Lexicon(bpe.compile_lexicon([], [])).find([b"a"]).tolist() == [-1]


def test_operator(spark):
    rows = [(1, "the the the other"), (2, None), (3, ""), (1, "the the the other"), (None, "don't"), (5, "x y " * 9000)]
    df = spark.createDataFrame([(i, t, "clash") for i, t in rows], "doc_id long, text string, ids string")
    got = bpe.encoded(df, PATH, words=50).collect()
    want = [(i, lib(t or "")) for i, t in rows]
    assert sorted(((r.doc_id, r.ids) for r in got), key=str) == sorted(want, key=str)
    for r in got:
        assert r.n_tokens == len(r.ids) and r.ids_sha256 == sha256(",".join(map(str, r.ids)).encode()).hexdigest()
        assert r.decoded_sha256 == sha256(LIB.decode(r.ids, skip_special_tokens=False).encode()).hexdigest()
    back = bpe.decoded(spark.createDataFrame([(r.doc_id, r.ids) for r in got], "doc_id long, ids array<int>"), PATH).collect()
    assert sorted(map(tuple, back), key=str) == sorted([(i, t or "") for i, t in rows], key=str)
    assert bpe.encoded(df.limit(0), PATH).count() == 0


def test_the_lexicon_leaves_out_long_words(spark):
    long = "x" * 5000 + "é" * 99
    docs = spark.createDataFrame([(i, f"some {long} words {'é' * 99} {'é' * 100} end") for i in range(4)], "doc_id long, text string").coalesce(1)
    words = bpe.frequent_words(docs, 100)
    assert {" some", " words"} <= {w if w.startswith(" ") else " " + w for w in words}
    assert any("é" * 99 in w for w in words) and max(len(w.encode()) for w in words) < bpe.LONG
    assert all(r.ids == lib(t) for r, t in zip(bpe.encoded(docs, PATH).orderBy("doc_id").collect(), [r.text for r in docs.orderBy("doc_id").collect()]))


def test_words_of_units_are_those_of_the_pattern():
    r = random.Random(3)
    texts = ["".join(r.choice("aab's'tlrevmd \n\t\r 1２é漢😀|<>\x85　\x1c.") for _ in range(r.randrange(9))) for _ in range(20_000)]
    units = [u for t in texts for u in (*bpe.CHUNK.findall(t), *(" " + u for u in t.split(" ")))]
    words, n = bpe.cut_words(pa.array(units, pa.large_string()))
    stops = n.cumsum().tolist()
    assert [words[a:b].to_pylist() for a, b in zip([0, *stops], stops)] == [bpe.WORD.findall(u) for u in units]
    assert bpe.cut_words(pa.array(["", " ", ""], pa.large_string()))[1].tolist() == [0, 1, 0]


def test_python_is_not_called_for_every_word():
    """Encoding took 961 CPU seconds a GB, most of them in calls for single words."""
    ENCODER.encode(["first use"])
    texts = [" ".join(f"w{i * 7919 % 50_021}, other" for i in range(j, j + 5000)) for j in range(0, 20_000, 5000)]
    calls = 0

    def count(frame, event, arg):
        nonlocal calls
        calls += event in ("call", "c_call")

    sys.setprofile(count)
    try:
        ids = ENCODER.encode(texts)
    finally:
        sys.setprofile(None)
    assert calls < 4000  # 20,000 words that differ
    assert ids == [lib(t) for t in texts]


def test_every_special_token_and_odd_texts_among_others():
    texts = ["a b", " x  y\n  z ", "<|endoftext|> a", "", " ", "a b", "don't 's <|endoftext|><|endoftext|>", "b\n c"] * 3
    assert ENCODER.encode(texts) == [lib(t) for t in texts]
    assert bpe.Encoder(V).encode(texts) == [lib(t) for t in texts]
