"""Cross-site boilerplate: lines that occur on many distinct sites, taken out of the documents that carry them.

Every line gets a HyperLogLog sketch of the sites it occurs on. Sketches are merged by aggregation, so a line's spread costs
a bounded number of bytes however often it occurs, and a line that occurs everywhere meets as one sketch a task. Lines whose
estimate lies near the threshold get an exact distinct count; the others are decided by the sketch alone.

A line counts without the spaces around it; blank lines are never boilerplate. A document whose characters are mostly widely
spread lines may be a copy of a widely copied text, for document deduplication to judge, or a short page amid much boilerplate. What its
lines are is told by other documents: a line is proven boilerplate if it also is widely spread among documents that are mostly text of their
own, counting copies of a text as one document on one site. Such lines go from every document; other spread lines only from
documents that are mostly their own text. A text that would be left without any character but spaces and line ends stays as it is.

Rows: a null text stays null and counts nothing; a null site counts as one site, the empty one. Repeated rows add no site and are
rewritten alike. Other columns are passed on unread. An empty table gives no rows.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from placeweave.llm.shared import query, stored, table

SITES = 10
MAX_SHARE = 0.5
SKETCH_LOG2 = 12
# Four standard errors of the sketch: estimates this close to the threshold are counted exactly.
BAND = 4 * 1.04 / 2 ** (SKETCH_LOG2 / 2)


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _key(line: Column) -> Column:
    return F.unhex(F.md5(line))


def _occurrences(docs: DataFrame, text: str, site: str) -> DataFrame:
    """key and site of every line that is not blank."""
    lines = docs.select(F.coalesce(F.col(site), F.lit("")).alias("site"), F.explode(_lines(F.col(text))).alias("line"))
    return lines.select("site", F.trim("line").alias("line")).where("line <> ''").select("site", _key(F.col("line")).alias("key"))


def _on_many_sites(seen: DataFrame, sites: int, label: str) -> DataFrame:
    """The keys of ``seen`` (key, site) with at least ``sites`` distinct sites: by sketch, near the threshold by an exact count."""
    margin = max(1.0, BAND * sites)
    guessed = stored(seen.groupBy("key").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", SKETCH_LOG2)).alias("guess"))
                     .where(F.col("guess") >= sites - margin), label)
    near = guessed.where(F.col("guess") <= sites + margin).select("key")
    counted = (seen.join(near, "key").groupBy("key").agg(F.count_distinct("site").alias("exact"))
               .where(F.col("exact") >= sites).select("key"))
    return guessed.where(F.col("guess") > sites + margin).select("key").union(counted)


def spread_lines(docs: DataFrame, *, text: str = "text", site: str = "source", sites: int = SITES) -> DataFrame:
    """Keys of the lines that occur on at least ``sites`` distinct sites."""
    return _on_many_sites(_occurrences(docs, text, site), sites, "line-spread")


def _marked(docs: DataFrame, text: str, site: str, sites: int, max_share: float) -> DataFrame:
    """whole (MD5 of a text) and marked, the places of the lines to take out of it."""
    spread = stored(spread_lines(docs, text=text, site=site, sites=sites), "spread-lines")
    # What is marked depends on the text alone, so places are kept per distinct text: no row identifier is needed.
    places = docs.select(F.unhex(F.md5(text)).alias("whole"), F.posexplode(_lines(F.col(text))).alias("at", "line"))
    sized = places.select("whole", "at", _key(F.trim("line")).alias("key"), F.length(F.trim("line")).alias("size"))
    hits = stored(sized.join(spread, "key", "left_semi").dropDuplicates(["whole", "at"]), "line-hits")
    covered = hits.groupBy("whole").agg(F.sum("size").alias("spread_chars"))
    chars = F.aggregate(_lines(F.col(text)), F.lit(0), lambda sum_, line: sum_ + F.length(F.trim(line)))
    texts = docs.select(F.unhex(F.md5(text)).alias("whole"), F.coalesce(F.col(site), F.lit("")).alias("site"), chars.alias("chars"))
    own = (texts.join(covered, "whole").where(F.col("spread_chars") <= max_share * F.col("chars"))
           .groupBy("whole").agg(F.min("site").alias("site")))
    own = stored(own, "line-own")
    proven = _on_many_sites(hits.join(own, "whole").select("key", "site"), sites, "line-proven")
    kept = hits.join(own.select("whole"), "whole", "left_semi").unionByName(
        hits.join(own.select("whole"), "whole", "left_anti").join(proven, "key", "left_semi").select(*hits.columns))
    return kept.groupBy("whole").agg(F.collect_set("at").alias("marked"))


def _without(texts: pd.Series, marked: pd.Series) -> pd.DataFrame:
    """The text without its marked lines, unless these hold all of its characters."""
    out = []
    for text, at in zip(texts, marked, strict=True):
        if text is None or at is None:
            out.append((None, 0))
            continue
        lines, gone = text.split("\n"), set(at)
        if any(line.strip(" ") for i, line in enumerate(lines) if i not in gone):
            out.append(("\n".join(line for i, line in enumerate(lines) if i not in gone), len(gone)))
        else:
            out.append((None, 0))
    return pd.DataFrame(out, columns=["text", "n_removed"])


def without_boilerplate(docs: DataFrame, *, text: str = "text", site: str = "source", sites: int = SITES,
                        max_share: float = MAX_SHARE) -> DataFrame:
    """``docs`` with widely spread lines taken out of the text column, and a column ``n_removed`` (lines taken out; it replaces one of that name).

    ``max_share`` is the share of a text's characters in widely spread lines up to which it counts as mostly its own.
    """
    marked = _marked(docs, text, site, sites, max_share)
    rows = docs.select(F.struct("*").alias("row"), F.unhex(F.md5(text)).alias("whole")).join(marked, "whole", "left")
    old = F.col("row").getField(text)
    rewritten = F.pandas_udf(_without, "text string, n_removed long")
    changed = rewritten(F.when(F.col("marked").isNotNull(), old), "marked")
    rows = rows.select("row", changed.alias("new"))
    columns = [F.coalesce("new.text", old).alias(c) if c == text else F.col("row").getField(c).alias(c)
               for c in docs.columns if c != "n_removed"]
    return rows.select(*columns, F.coalesce("new.n_removed", F.lit(0)).alias("n_removed"))


@query("""
    WITH line AS (
        SELECT doc_id, coalesce(source, '') AS site, unnest(string_split(text, chr(10))) AS line,
               generate_subscripts(string_split(text, chr(10)), 1) AS pos
        FROM documents),
    spread AS (SELECT trim(line) AS line FROM line WHERE trim(line) <> '' GROUP BY 1 HAVING count(DISTINCT site) >= 10),
    marked AS (SELECT doc_id, pos, line.line, spread.line IS NOT NULL AS hit
               FROM line LEFT JOIN spread ON trim(line.line) = spread.line),
    share AS (SELECT doc_id, sum(length(trim(line))) FILTER (WHERE hit) <= 0.5 * sum(length(trim(line))) AS own
              FROM marked GROUP BY 1 HAVING count(*) FILTER (WHERE hit) > 0),
    home AS (SELECT text, min(coalesce(source, '')) AS site FROM documents GROUP BY 1),
    proven AS (SELECT trim(line) AS line FROM marked JOIN share USING (doc_id) JOIN documents USING (doc_id) JOIN home USING (text)
               WHERE hit AND own GROUP BY 1 HAVING count(DISTINCT site) >= 10),
    judged AS (SELECT doc_id, pos, marked.line, hit AND (own OR proven.line IS NOT NULL) AS gone
               FROM marked LEFT JOIN share USING (doc_id) LEFT JOIN proven ON trim(marked.line) = proven.line),
    page AS (
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_gone,
               coalesce(sum(length(trim(line))) FILTER (WHERE NOT gone), 0) > 0 AS left_over,
               coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS rest
        FROM judged GROUP BY 1)
    SELECT doc_id, CASE WHEN n_gone > 0 AND left_over THEN rest ELSE text END AS text,
           coalesce(n_lines, 0) AS n_lines, CASE WHEN left_over THEN n_gone ELSE 0 END AS n_removed
    FROM documents LEFT JOIN page USING (doc_id)
""")
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "text", "source", F.coalesce(F.size(_lines(F.col("text"))), F.lit(0)).cast("long").alias("n_lines"))
    return without_boilerplate(docs).select("doc_id", "text", "n_lines", "n_removed")
