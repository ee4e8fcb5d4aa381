"""Spread lines against exact distinct counts in plain Python."""
from collections import defaultdict

from meterflow.llm import line_spread

SF = "/root/testdata/sf0.001"


def brute(rows, min_sites):
    sites = defaultdict(set)
    for _, s, t in rows:
        for x in (t or "").split("\n"):
            sites[x.strip(line_spread.BLANKS)].add(s)
    out = []
    for i, _, t in rows:
        if t is None:
            out.append((i, None, 0, 0, 0, 0))
            continue
        lines = t.split("\n")
        bare = [x.strip(line_spread.BLANKS) for x in lines]
        hit = [bool(b) and len(sites[b]) >= min_sites for b in bare]
        gone = sum(len(b) for b, h in zip(bare, hit) if h)
        if 0 < sum(hit) < sum(map(bool, bare)):
            out.append((i, "\n".join(x for x, h in zip(lines, hit) if not h), sum(map(bool, bare)), sum(hit), sum(hit), gone))
        else:
            out.append((i, t, sum(map(bool, bare)), sum(hit), 0, 0))
    return sorted(out, key=str)


def run(df, n):
    got = line_spread.drop_spread_lines(df, "source", n)
    return sorted(((r.doc_id, r.text, r.n_lines, r.n_spread, r.n_removed, r.removed_chars) for r in got.collect()), key=str)


def test_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.source, r.text) for r in docs.collect()]
    for n in (2, 5):
        assert run(docs, n) == brute(rows, n)
    assert line_spread.drop_spread_lines(docs).columns[:5] == docs.columns


def test_edges(spark):
    rows = [(i, f"s{i % 40}", f"unique text number {i} here\n  shared footer \t\nnear {i % 4}\n") for i in range(80)]
    rows += [(200, None, "shared footer\nown words that are longer than that"), (201, "s1", None), (202, "s1", ""), (203, "s2", " \n\n"),
             (None, "s3", "shared footer\nanother long line that stays here"), (5, "s9", "shared footer"), (0, "s0", rows[0][2])]
    df = spark.createDataFrame([(i, s, t, 9) for i, s, t in rows], "doc_id long, source string, text string, n_lines int").repartition(3)
    for n in (3, 11, 41, 42):  # 40 sites and the null one hold the footer; "near" lines stand on 10 each
        assert run(df, n) == brute(rows, n)
    assert line_spread.drop_spread_lines(df.limit(0)).count() == 0


def test_own_lines_stay_and_spread_ones_go(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(i, f"s{i}", f"own {i}\na footer that is much longer than the line above it") for i in range(6)] + [(9, "s1", "a footer that is much longer than the line above it\n")]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = {r.doc_id: (r.text, r.n_removed) for r in line_spread.drop_spread_lines(df, min_sites=5).collect()}
    assert got == {**{i: (f"own {i}", 1) for i in range(6)}, 9: (rows[-1][2], 0)}
    for r in line_spread.drop_spread_lines(docs, min_sites=5).collect():
        assert r.n_removed == (r.n_spread if r.n_spread < r.n_lines else 0)


def test_any_column_name_passes(spark):
    names = ["_id", "_t", "_t1", "_pos", "of", "of_text", "pos", "row", "t", "h1", "site"]
    rows = [(i, f"s{i % 6}", f"own {i}\nshared by all of them", *(f"{c}{i}" for c in names)) for i in range(12)]
    df = spark.createDataFrame(rows, ["doc_id", "source", "text", *names])
    for r in line_spread.drop_spread_lines(df).collect():
        assert r.text == f"own {r.doc_id}" and r.n_removed == 1 and all(r[c] == f"{c}{r.doc_id}" for c in names)
