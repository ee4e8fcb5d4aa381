"""Line dedup by distinct-site spread (operator 7).

A line that stands on many sites is boilerplate. Per hash of a line:

1. count, least and greatest site in one grouping; only lines that are on two
   sites at least go on (exact, fixed-size state);
2. a HyperLogLog sketch of the sites of each such line, merged by aggregation;
3. lines whose estimate is near the threshold get an exact distinct count, the
   others are decided by their sketch;
4. boilerplate lines are removed wherever they stand. A document without any
   other line that has a word is a copy of others, not a page with
   boilerplate, and is left whole for document-level dedup.

Only hashes are shuffled by line; the texts move once, to meet the numbers of
their removed lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.llm.scratch import saved

BLANKS = " \t\n\x0b\x0c\r"
LG_K = 12  # 2 ** 12 registers: a standard error of 1.6 %


def hashed_lines(docs: DataFrame, site: str) -> DataFrame:
    """(doc_id, t1, pos, h1, h2, site): every line that has a word, blanks at its ends left out.

    ``t1`` hashes the text, so that rows that share a doc_id but not a text stay apart.
    """
    lines = docs.select("doc_id", F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(1), F.col(site)).alias("site"),
                        F.posexplode(F.split("text", "\n")).alias("pos", "raw"))
    line = F.btrim("raw", F.lit(BLANKS))
    return lines.withColumn("line", line).filter("line != ''").select(
        "doc_id", "t1", "pos", F.xxhash64("line").alias("h1"), F.hash("line").alias("h2"), "site")


def spread_lines(lines: DataFrame, min_sites: int) -> DataFrame:
    """(h1, h2) of the lines that stand on ``min_sites`` sites or more."""
    keys = ["h1", "h2"]
    wide = saved(lines.groupBy(*keys).agg(F.min("site").alias("a"), F.max("site").alias("b"))
                 .filter("a != b").select(*keys), "lines-wide")
    on = saved(lines.join(wide, keys, "left_semi").groupBy(*keys)
               .agg(F.hll_sketch_agg("site", F.lit(LG_K)).alias("sketch"))
               .select(*keys, F.hll_sketch_estimate("sketch").alias("sites")), "lines-sketches")
    margin = 1 + 0.1 * min_sites  # six standard errors
    sure = on.filter(F.col("sites") > min_sites + margin).select(*keys)
    near = on.filter(F.abs(F.col("sites") - min_sites) <= margin).select(*keys)
    exact = (lines.join(near, keys, "left_semi").select(*keys, "site").distinct()
             .groupBy(*keys).agg(F.count("*").alias("sites")).filter(F.col("sites") >= min_sites).select(*keys))
    return saved(sure.union(exact), "lines-spread")


def drop_spread_lines(docs: DataFrame, site: str = "source", min_sites: int = 5) -> DataFrame:
    """``docs`` with boilerplate lines taken out of ``text``, and the columns
    n_lines (with a word), n_spread (of these on ``min_sites`` sites or more),
    n_removed and removed_chars (code points without the blanks at line ends).

    Nothing is removed where no other line has a word. A null text stays null,
    with zeros; an empty text stays empty; a null site counts as one site.
    Every row stays a row, repeated ones too. All other columns pass through,
    whatever their names; columns named like the four are replaced.
    """
    added = ["n_lines", "n_spread", "n_removed", "removed_chars"]
    docs = docs.drop(*added)
    lines = saved(hashed_lines(docs, site), "lines")
    hits = (lines.join(spread_lines(lines, min_sites), ["h1", "h2"], "left_semi")
            .groupBy(F.col("doc_id").alias("of"), F.col("t1").alias("of_text")).agg(F.collect_set("pos").alias("pos")))
    rows = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"), F.xxhash64("text").alias("t"))
    with_hits = rows.join(hits, F.col("row.doc_id").eqNullSafe(F.col("of")) & (F.col("t") == F.col("of_text")), "left").select("row", "pos")
    # on the JVM: a one-element array binds the lines, so that a text is split once
    bare = lambda x: F.btrim(x, F.lit(BLANKS))
    done = F.transform(F.array(F.split("row.text", "\n")), lambda line: F.struct(
        F.size(F.filter(line, lambda x: bare(x) != "")).alias("n"), F.array_join(F.transform(
            F.array_except(F.sequence(F.lit(0), F.size(line) - 1), "pos"), lambda i: F.element_at(line, i + 1)), "\n").alias("rest"),
        F.aggregate("pos", F.lit(0), lambda s, i: s + F.length(bare(F.element_at(line, i + 1)))).alias("gone")))[0]
    out = with_hits.select("row", F.coalesce("pos", F.array().cast("array<int>")).alias("pos")).withColumn("hits", F.size("pos"))
    out = out.select("row", "hits", done.alias("d"))
    cut = F.coalesce((F.col("hits") > 0) & (F.col("hits") < F.col("d.n")), F.lit(False))
    counts = (F.coalesce("d.n", F.lit(0)), F.col("hits"), F.when(cut, F.col("hits")).otherwise(0), F.when(cut, F.col("d.gone")).otherwise(0))
    return out.select(*(F.when(cut, F.col("d.rest")).otherwise(F.col("row.text")).alias(c) if c == "text" else F.col("row")[c].alias(c)
                        for c in docs.columns), *(x.cast("long").alias(c) for x, c in zip(counts, added, strict=True)))


ORACLE_SQL = """
WITH raw AS (SELECT doc_id, source, text, row_number() OVER () AS r FROM documents),
lines AS (SELECT r, doc_id, source, u.pos, u.line, trim(u.line, chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)) AS bare
          FROM raw, unnest(string_split(text, chr(10))) WITH ORDINALITY AS u(line, pos) WHERE text IS NOT NULL),
spread AS (SELECT bare FROM lines WHERE bare <> '' GROUP BY bare
           HAVING count(DISTINCT coalesce('s' || source, 'n')) >= 5),
marked AS (SELECT l.*, s.bare IS NOT NULL AS hit FROM lines l LEFT JOIN spread s ON l.bare = s.bare),
per AS (SELECT r, count(*) FILTER (bare <> '') AS n_lines, count(*) FILTER (hit) AS n_spread,
               coalesce(sum(length(bare)) FILTER (hit), 0) AS gone,
               string_agg(line, chr(10) ORDER BY pos) FILTER (NOT hit) AS rest
        FROM marked GROUP BY r)
SELECT raw.doc_id, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(n_spread, 0) AS BIGINT) AS n_spread,
       CAST(CASE WHEN n_spread > 0 AND n_spread < n_lines THEN n_spread ELSE 0 END AS BIGINT) AS n_removed,
       CAST(CASE WHEN n_spread > 0 AND n_spread < n_lines THEN gone ELSE 0 END AS BIGINT) AS removed_chars,
       CASE WHEN n_spread > 0 AND n_spread < n_lines THEN sha256(coalesce(rest, '')) ELSE sha256(raw.text) END AS text_sha256
FROM raw LEFT JOIN per USING (r)
"""
