"""Mixing sources to target weights: a token budget handed down a domain-language-source tree, then filled from seeded epochs.

A budget is shared out among siblings by weight. A sibling that cannot use its share (it holds fewer tokens than its epochs
can yield) gives the rest to its siblings, again by weight; only what the whole family cannot use goes back to the ancestors' families.
All of it is integer arithmetic over the tree's few rows, in windows over siblings.

A leaf takes as many whole epochs as its budget holds, and of the next epoch the longest prefix, in that epoch's seeded order,
whose tokens fit. The cut is found by bucket sums first and inside one bucket then, so no leaf is ever ordered in one task,
and texts are not shuffled: a document only compares its key with its leaf's cut.

Rows: a null language counts as ``und``, a null source as the empty one. A document without tokens (null, empty or white space) is never
selected: there is nothing to read. Repeated rows share one key and are selected together. A node of weight 0 gets nothing.
Other columns are passed on unread. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from placeweave.llm.shared import query, stored, table

LEVELS = ("domain", "lang", "source")
# Target weights a level; names that are not listed weigh 1.
WEIGHTS = {"domain": {"web": 5, "books": 3, "reference": 2}, "lang": {"en": 6, "de": 2}}
BUDGET_PERCENT = 60
EPOCHS = 4
SEED = 17
ROWS_PER_BUCKET = 20_000
WORD = r"[^\x20\x09-\x0D]+"


def domain_of(source: Column) -> Column:
    """src0-src9 are web pages, src10-src14 books, src15-src19 reference works."""
    n = F.regexp_extract(source, r"^src([0-9]{1,4})$", 1).try_cast("int")
    return (F.when(n <= 9, "web").when(n <= 14, "books").when(n <= 19, "reference").otherwise("other"))


def _big(name: str) -> Column:
    return F.col(name).cast("decimal(19,0)")


def shared_out(tree: DataFrame, parents: list[str], level: str) -> DataFrame:
    """``budget`` of every node of one level, from ``family_budget``, ``weight`` and ``capacity``."""
    family = Window.partitionBy(*parents) if parents else Window.partitionBy(F.lit(0))
    by_need = family.orderBy(F.col("capacity") / F.col("weight"), level)
    upto = by_need.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_need.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    ranked = (tree.where("weight > 0")
              .withColumn("left", F.col("family_budget") - F.coalesce(F.sum("capacity").over(upto), F.lit(0)))
              .withColumn("weights", F.sum("weight").over(onward))
              .withColumn("full", _big("capacity") * _big("weights") <= _big("left") * _big("weight")))
    # Whoever is full takes its capacity; the others share what is left, each up to its place in the order of names.
    open_weight = F.when(F.col("full"), 0).otherwise(F.col("weight"))
    ranked = (ranked.withColumn("rest", F.col("family_budget") - F.sum(F.when(F.col("full"), F.col("capacity")).otherwise(0)).over(family))
              .withColumn("open", F.sum(open_weight).over(family))
              .withColumn("until", F.sum(open_weight).over(family.orderBy(level).rowsBetween(Window.unboundedPreceding, 0))))
    share = F.expr("""
        cast(rest AS decimal(19,0)) * cast(until AS decimal(19,0)) div cast(open AS decimal(19,0))
        - cast(rest AS decimal(19,0)) * cast(until - weight AS decimal(19,0)) div cast(open AS decimal(19,0))""")
    return ranked.select(*parents, level, F.when(F.col("full"), F.col("capacity")).otherwise(share).cast("long").alias("budget"))


def leaf_budgets(leaves: DataFrame, *, levels=LEVELS, weights: Mapping[str, Mapping[str, int]] = WEIGHTS,
                 percent: int = BUDGET_PERCENT, epochs: int = EPOCHS) -> DataFrame:
    """``budget`` of every leaf: the levels' columns, tokens, docs and budget. ``leaves`` holds a row a leaf."""
    def weight(level):
        listed = weights.get(level, {})
        found = F.lit(1)
        for name, value in listed.items():
            found = F.when(F.col(level) == name, F.lit(value)).otherwise(found)
        return found.cast("long")

    # A node can use what its children can; children of weight 0 count for nothing.
    capacities, nodes = {}, leaves.withColumn("capacity", F.col("tokens") * epochs)
    for depth in range(len(levels), 0, -1):
        names = list(levels[:depth])
        nodes = nodes.groupBy(*names).agg(F.sum("capacity").alias("capacity"))
        nodes = nodes.withColumn("weight", weight(levels[depth - 1]))
        capacities[depth] = nodes
        nodes = nodes.where("weight > 0")
    total = leaves.agg(F.sum("tokens")).first()[0] or 0
    usable = F.sum(F.when(F.col("weight") > 0, F.col("capacity")).otherwise(0)).over(Window.partitionBy(F.lit(0)))
    tree = capacities[1].withColumn("family_budget", F.least(F.lit(total * percent // 100).cast("long"), usable))
    budgets = None
    for depth, level in enumerate(levels, start=1):
        parents = list(levels[:depth - 1])
        if parents:
            tree = capacities[depth].join(budgets, parents)
        budgets = shared_out(tree, parents, level).withColumnRenamed("budget", "family_budget")
    return leaves.join(budgets.withColumnRenamed("family_budget", "budget"), list(levels))


def _placed(docs: DataFrame, text: str, lang: str, source: str, key: str) -> DataFrame:
    """The tree's columns, tokens and identifier next to the row itself."""
    site = F.coalesce(F.col(source), F.lit(""))
    return docs.select(F.struct("*").alias("row"), domain_of(site).alias("domain"), F.coalesce(F.col(lang), F.lit("und")).alias("lang"),
                       site.alias("source"), F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long").alias("tokens"),
                       F.coalesce(F.col(key).cast("string"), F.lit("")).alias("id")).where("tokens > 0")


def _order_key(seed: int) -> Column:
    """Where a document stands in the leaf's epoch ``whole``."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("whole").cast("string"), "id"))


def _cuts(placed: DataFrame, leaves: DataFrame, levels, seed: int) -> DataFrame:
    """Per leaf: ``whole`` epochs, and ``cut``, the last key of the next epoch that still fits (null: none does)."""
    levels = list(levels)
    bucket = F.expr("cast(conv(substr(key, 1, 8), 16, 10) AS bigint) * buckets div 4294967296")
    keyed = (placed.select(*levels, "tokens", "id").join(leaves, levels).withColumn("key", _order_key(seed))
             .select(*levels, "tokens", "key", "rest", bucket.alias("bucket")))
    order = Window.partitionBy(*levels).orderBy("bucket")
    sums = (keyed.groupBy(*levels, "bucket").agg(F.sum("tokens").alias("sum"), F.first("rest").alias("rest"), F.max("key").alias("last"))
            .withColumn("until", F.sum("sum").over(order)))
    full = sums.where("until <= rest").groupBy(*levels).agg(F.max("last").alias("cut"))
    partly = sums.where("until > rest").groupBy(*levels).agg(F.min_by(F.struct("bucket", (F.col("until") - F.col("sum")).alias("before")), "bucket").alias("b"))
    partly = partly.select(*levels, "b.bucket", "b.before")
    inside = (keyed.join(partly, [*levels, "bucket"])
              .withColumn("until", F.col("before") + F.sum("tokens").over(Window.partitionBy(*levels, "bucket").orderBy("key")))
              .where("until <= rest").groupBy(*levels).agg(F.max("key").alias("cut")))
    return full.union(inside).groupBy(*levels).agg(F.max("cut").alias("cut"))


def mixed_to_weights(docs: DataFrame, *, text: str = "text", lang: str = "lang", source: str = "source", key: str = "doc_id",
                     weights: Mapping[str, Mapping[str, int]] = WEIGHTS, percent: int = BUDGET_PERCENT, epochs: int = EPOCHS,
                     seed: int = SEED, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """The selected rows of ``docs`` with ``mix_domain``, ``mix_tokens`` and ``mix_copies`` (how often to read the document).

    Columns of these names in ``docs`` are replaced.
    """
    levels = list(LEVELS)
    placed = _placed(docs, text, lang, source, key)
    # Tokens are counted once for budgets and cuts; those steps read this narrow table and no text.
    narrow = stored(placed.select(*levels, "tokens", "id"), "mix-tokens")
    counted = narrow.groupBy(*levels).agg(F.sum("tokens").alias("tokens"), F.count("*").alias("docs"))
    leaves = leaf_budgets(stored(counted, "mix-leaves"), levels=LEVELS, weights=weights, percent=percent, epochs=epochs).select(
        *levels, F.expr("budget div tokens").alias("whole"), F.expr("budget % tokens").alias("rest"),
        F.ceil(F.col("docs") / rows_per_bucket).alias("buckets"))
    leaves = stored(leaves, "mix-budgets")
    cuts = stored(leaves.join(_cuts(narrow, leaves, levels, seed), levels, "left").select(*levels, "whole", "cut"), "mix-cuts")
    chosen = placed.join(cuts, levels)
    copies = F.col("whole") + F.when(_order_key(seed) <= F.col("cut"), 1).otherwise(0)
    chosen = chosen.withColumn("copies", copies.cast("long")).where("copies > 0")
    own = [F.col("row").getField(c).alias(c) for c in docs.columns if c not in ("mix_domain", "mix_tokens", "mix_copies")]
    return chosen.select(*own, F.col("domain").alias("mix_domain"), F.col("tokens").alias("mix_tokens"), F.col("copies").alias("mix_copies"))


def _oracle() -> str:
    def level(parents: list[str], name: str, above: str, below: str) -> str:
        family = f"PARTITION BY {', '.join(parents)}" if parents else ""
        cols = ", ".join([*parents, name])
        join = f"JOIN {above} USING ({', '.join(parents)})" if parents else f"CROSS JOIN {above}"
        listed = " ".join(f"WHEN '{k}' THEN {v}" for k, v in WEIGHTS.get(name, {}).items())
        weight = f"CASE {name} {listed} ELSE 1 END" if listed else "1"
        return f"""
        {name}_node AS (SELECT {cols}, sum(capacity)::BIGINT AS capacity, ({weight})::BIGINT AS weight FROM {below} GROUP BY {cols}),
        {name}_rank AS (
            SELECT *, family_budget - coalesce(sum(capacity) OVER (upto ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS room,
                   sum(weight) OVER (upto ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights
            FROM {name}_node {join} WINDOW upto AS ({family} ORDER BY capacity::DOUBLE / weight::DOUBLE, {name})),
        {name}_full AS (SELECT *, capacity::HUGEINT * weights <= room::HUGEINT * weight AS is_full FROM {name}_rank),
        {name}_rest AS (
            SELECT *, family_budget - sum(CASE WHEN is_full THEN capacity ELSE 0 END) OVER ({family}) AS rest,
                   sum(CASE WHEN is_full THEN 0 ELSE weight END) OVER ({family}) AS open_weight,
                   sum(CASE WHEN is_full THEN 0 ELSE weight END) OVER ({family} ORDER BY {name} ROWS UNBOUNDED PRECEDING) AS until
            FROM {name}_full),
        {name}_budget AS (
            SELECT {cols}, (CASE WHEN is_full THEN capacity ELSE (rest::HUGEINT * until) // greatest(open_weight, 1)
                            - (rest::HUGEINT * (until - weight)) // greatest(open_weight, 1) END)::BIGINT AS family_budget
            FROM {name}_rest)"""
    return rf"""
    WITH counted AS (
        SELECT doc_id, coalesce(lang, 'und') AS lang, coalesce(source, '') AS source,
               TRY_CAST(regexp_extract(source, '^src([0-9]{{1,4}})$', 1) AS INTEGER) AS n,
               length(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS tokens
        FROM documents),
    placed AS (
        SELECT *, CASE WHEN n <= 9 THEN 'web' WHEN n <= 14 THEN 'books' WHEN n <= 19 THEN 'reference' ELSE 'other' END AS domain
        FROM counted WHERE tokens > 0),
    leaf AS (SELECT domain, lang, source, sum(tokens)::BIGINT AS tokens, sum(tokens)::BIGINT * {EPOCHS} AS capacity FROM placed GROUP BY ALL),
    budget AS (SELECT least(sum(tokens) * {BUDGET_PERCENT} // 100, sum(capacity))::BIGINT AS family_budget FROM leaf),
    {level([], "domain", "budget", "leaf")},
    {level(["domain"], "lang", "domain_budget", "leaf")},
    {level(["domain", "lang"], "source", "lang_budget", "leaf")},
    cut AS (SELECT domain, lang, source, family_budget // tokens AS whole, family_budget % tokens AS rest
            FROM leaf JOIN source_budget USING (domain, lang, source)),
    keyed AS (SELECT *, md5(concat_ws(':', '{SEED}', whole::VARCHAR, doc_id::VARCHAR)) AS key FROM placed JOIN cut USING (domain, lang, source)),
    summed AS (SELECT *, sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY key) AS until FROM keyed),
    copied AS (SELECT *, (whole + CASE WHEN until <= rest THEN 1 ELSE 0 END)::BIGINT AS copies FROM summed)
    SELECT doc_id, domain, lang, source, tokens, copies FROM copied WHERE copies > 0
    """


@query(_oracle())
def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixed_to_weights(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", F.col("mix_domain").alias("domain"), F.coalesce("lang", F.lit("und")).alias("lang"),
                        F.coalesce("source", F.lit("")).alias("source"), F.col("mix_tokens").alias("tokens"), F.col("mix_copies").alias("copies"))
