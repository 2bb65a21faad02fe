"""Mixing sources to target weights: hierarchical budgeting over domain, language and source.

A token budget is handed down a tree. At each node the children get shares in
proportion to their weights, none more than it can use (``max_epochs`` times the
tokens below it); what a child cannot use goes to its siblings in proportion, and
only what a whole family cannot use reaches the families beside it, because a
family's own limit is the sum of its leaves'. Shares are whole tokens, rounded
down, so a node may leave as many tokens unspent as it has children.

A leaf with budget b and s tokens repeats its documents in b div s whole epochs,
and takes of the next epoch, put in an order seeded by (seed, epoch, document),
the longest prefix of documents within the b mod s tokens left.

All of it is DataFrame expressions. Tokens are words ``[^\\x20\\x09-\\x0D]+``.

Scale. Texts are read once, to count tokens; all else works on (id, leaf, count)
rows. The prefix of a leaf is found in two steps: its order is cut into buckets of
about ``bucket_rows`` documents by the seeded hash, running sums over bucket
totals find the bucket in which the budget ends, and only that bucket is summed
row by row. So a leaf with a third of all rows is many small tasks, never one.

Defined cases: a null domain, language or source is the leaf ``unknown``; a null
text has no tokens; rows of one leaf with one id stand or fall together and come
back as one row (n_rows, n_tokens summed); rows without an id go by their text;
weights not listed are 1, a weight of 0 gives nothing; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.tables import stage

TOKEN = r"[^\x20\x09-\x0D]+"
LEVELS = ("domain", "lang", "source")
SEED = 20
MAX_EPOCHS = 3
SHARE = (1, 2)  # of the tokens there are
BUCKET_ROWS = 4096

#: target weights by level; what is not listed weighs 1
WEIGHTS = {
    "domain": {"domain0": 4, "domain1": 3, "domain2": 2, "domain3": 1},
    "lang": {"en": 4, "de": 2, "fr": 2, "es": 2},
    "source": {},
}


def domain_of(source: Column) -> Column:
    """Sources are dealt to four domains by the number in their name; others are ``domain0``."""
    digits = F.regexp_extract(source, r"(\d{1,9})$", 1)
    return F.concat(F.lit("domain"), F.when(digits == "", "0").otherwise(
        (F.when(digits == "", "0").otherwise(digits).cast("long") % 4).cast("string")))


def _weight(level: str, weights: dict) -> Column:
    listed = weights.get(level) or {}
    if any(w < 0 or int(w) != w for w in listed.values()):
        raise ValueError("weights are whole numbers, 0 or more")
    out = F.lit(1).cast("long")
    for name, w in listed.items():
        out = F.when(F.col(level) == name, F.lit(int(w)).cast("long")).otherwise(out)
    return out


def _hand_down(nodes: DataFrame, parent: tuple[str, ...], level: str, weights: dict) -> DataFrame:
    """Budgets of nodes (parent columns, level, budget of the parent, limit) by filling up to limits.

    Children in the order of limit by weight: one is full if its limit is no more
    than its share of what the ones before leave; from the first that is not full
    on, all share by weight.
    """
    w = nodes.withColumn("w", _weight(level, weights)).withColumn(
        "limit", F.when(F.col("w") > 0, F.col("limit")).otherwise(F.lit(0).cast("long")))
    order = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    by = order.orderBy((F.col("limit") / F.greatest(F.col("w"), F.lit(1))).asc(), F.col(level).asc())
    w = (w.withColumn("before", F.coalesce(F.sum("limit").over(by.rowsBetween(Window.unboundedPreceding, -1)),
                                           F.lit(0).cast("long")))
         .withColumn("heavy", F.sum("w").over(by.rowsBetween(0, Window.unboundedFollowing)))
         .withColumn("full", (F.col("limit").cast("decimal(19,0)") * F.col("heavy")
                              <= (F.col("budget") - F.col("before")).cast("decimal(19,0)") * F.col("w")).cast("int"))
         .withColumn("full", F.min("full").over(by.rowsBetween(Window.unboundedPreceding, 0)) == 1)
         .withColumn("left", F.col("budget") - F.coalesce(
             F.sum(F.when(F.col("full"), F.col("limit"))).over(order), F.lit(0).cast("long")))
         .withColumn("sharing", F.sum(F.when(~F.col("full"), F.col("w"))).over(order)))
    share = F.expr("cast(cast(`left` AS decimal(19,0)) * w div sharing AS bigint)")
    return w.withColumn("budget", F.when(F.col("full"), F.col("limit")).otherwise(share)).select(
        *parent, level, "budget")


def budgets(leaves: DataFrame, weights: dict = WEIGHTS, share=SHARE, max_epochs: int = MAX_EPOCHS,
            levels=LEVELS) -> DataFrame:
    """Budget of each leaf (level columns, n_docs, supply): adds ``budget`` in tokens."""
    total = int(leaves.agg(F.sum("supply")).first()[0] or 0)
    limits = leaves.withColumn("limit", F.col("supply") * max_epochs)
    above = None
    for i, level in enumerate(levels):
        parent = tuple(levels[:i])
        nodes = limits.groupBy(*parent, level).agg(F.sum("limit").alias("limit"))
        nodes = (nodes.join(above, list(parent)) if parent else
                 nodes.withColumn("budget", F.lit(total * int(share[0]) // int(share[1])).cast("long")))
        above = _hand_down(nodes, parent, level, weights)
    return leaves.join(above, list(levels))


def select_documents(docs: DataFrame, domain: Column | None = None, weights: dict = WEIGHTS, share=SHARE,
                     max_epochs: int = MAX_EPOCHS, seed: int = SEED, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """The documents of the mix: doc_id, levels, n_rows, n_tokens, copies (1 or more)."""
    named = {level: F.coalesce(F.col(level), F.lit("unknown")) for level in ("lang", "source")}
    domain = domain_of(named["source"]) if domain is None else domain
    text = F.coalesce(F.col("text"), F.lit(""))
    key = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text:"), F.md5(text)))
    counted = docs.select("doc_id", F.coalesce(domain, F.lit("unknown")).alias("domain"),
                          *(c.alias(n) for n, c in named.items()), key.alias("key"),
                          F.regexp_count(text, F.lit(TOKEN)).cast("long").alias("n"))
    rows = stage(counted.groupBy(*LEVELS, "key").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n_rows"),
                                                     F.sum("n").alias("n_tokens")), "mix-rows")
    leaves = stage(budgets(rows.groupBy(*LEVELS).agg(F.count("*").alias("n_docs"), F.sum("n_tokens").alias("supply")),
                           weights, share, max_epochs), "mix-leaves")
    plan = leaves.filter("supply > 0 AND budget > 0").select(
        *LEVELS, F.expr("budget div supply").alias("epochs"), F.expr("budget % supply").alias("rest"),
        F.greatest(F.lit(1), F.expr(f"n_docs div {int(bucket_rows)}")).alias("buckets"))
    order = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("epochs").cast("string"), F.col("key")))
    placed = (rows.join(plan, list(LEVELS)).withColumn("order", order)
              .withColumn("bucket", F.expr("cast(conv(substr(`order`, 1, 7), 16, 10) AS bigint) * buckets div 268435456")))
    in_leaf = Window.partitionBy(*LEVELS).orderBy("bucket")
    sums = (placed.groupBy(*LEVELS, "bucket").agg(F.sum("n_tokens").alias("size"))
            .withColumn("upto", F.sum("size").over(in_leaf.rowsBetween(Window.unboundedPreceding, 0)))
            .withColumn("start", F.col("upto") - F.col("size")).select(*LEVELS, "bucket", "upto", "start"))
    placed = placed.join(sums, [*LEVELS, "bucket"])
    kept = [*LEVELS, "doc_id", "n_rows", "n_tokens", "epochs"]
    within = placed.filter("upto <= rest").select(*kept, F.lit(1).cast("long").alias("more"))
    beyond = placed.filter("start > rest").select(*kept, F.lit(0).cast("long").alias("more"))
    by = Window.partitionBy(*LEVELS, "bucket").orderBy("order", "key")
    last = (placed.filter("start <= rest AND upto > rest").withColumn("run", F.col("start") + F.sum("n_tokens").over(by))
            .select(*kept, (F.col("run") <= F.col("rest")).cast("long").alias("more")))
    return (within.unionByName(beyond).unionByName(last)
            .select("doc_id", *LEVELS, "n_rows", "n_tokens", (F.col("epochs") + F.col("more")).alias("copies"))
            .filter("copies > 0"))


def oracle_sql(weights: dict = WEIGHTS, share=SHARE, max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> str:
    """The same selection in DuckDB, with one running sum per leaf."""
    def weight(level: str) -> str:
        listed = "".join(f" WHEN '{k}' THEN {v}" for k, v in (weights.get(level) or {}).items())
        return f"CASE {level}{listed} ELSE 1 END" if listed else "1"

    parts = ["""d AS (SELECT doc_id, coalesce(lang, 'unknown') AS lang, coalesce(source, 'unknown') AS source,
  coalesce(text, '') AS text FROM documents),
c AS (SELECT doc_id, 'domain' || CASE WHEN regexp_extract(source, '(\\d{1,9})$', 1) = '' THEN 0
    ELSE regexp_extract(source, '(\\d{1,9})$', 1)::BIGINT % 4 END AS domain, lang, source,
  coalesce(doc_id::VARCHAR, 'text:' || md5(text)) AS key,
  len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'))::BIGINT AS n FROM d),
rows AS (SELECT domain, lang, source, key, min(doc_id) AS doc_id, count(*) AS n_rows, sum(n)::BIGINT AS n_tokens
  FROM c GROUP BY ALL),
leaves AS (SELECT domain, lang, source, sum(n_tokens)::BIGINT AS supply FROM rows GROUP BY ALL)""",
             f"b0 AS (SELECT (sum(supply)::HUGEINT * {share[0]} // {share[1]})::BIGINT AS budget FROM leaves)"]
    for i, level in enumerate(LEVELS):
        parent = ", ".join(LEVELS[:i])
        group = f"{parent}, {level}" if parent else level
        join = f"JOIN b{i} USING ({parent})" if parent else "CROSS JOIN b0"
        part = f"PARTITION BY {parent} " if parent else ""
        w = weight(level)
        parts += [
            f"n{i} AS (SELECT {group}, budget, {w} AS w, CASE WHEN {w} > 0 THEN lim ELSE 0 END AS lim FROM "
            f"(SELECT {group}, sum(supply * {max_epochs})::BIGINT AS lim FROM leaves GROUP BY {group}) {join})",
            f"o{i} AS (SELECT *, coalesce(sum(lim) OVER (a ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, "
            f"sum(w) OVER (a ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS heavy FROM n{i} "
            f"WINDOW a AS ({part}ORDER BY lim::DOUBLE / greatest(w, 1), {level}))",
            f"f{i} AS (SELECT *, min((lim::HUGEINT * heavy <= (budget - before)::HUGEINT * w)::INT) OVER ({part}"
            f"ORDER BY lim::DOUBLE / greatest(w, 1), {level} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS is_full "
            f"FROM o{i})",
            f"b{i + 1} AS (SELECT {group}, CASE WHEN is_full = 1 THEN lim ELSE ((budget - coalesce(sum(CASE WHEN is_full = 1 "
            f"THEN lim END) OVER ({part}), 0))::HUGEINT * w // sum(CASE WHEN is_full = 0 THEN w END) OVER ({part}))::BIGINT END "
            f"AS budget FROM f{i})",
        ]
    parts += [f"""plan AS (SELECT domain, lang, source, budget // supply AS epochs, budget % supply AS rest
  FROM leaves JOIN b{len(LEVELS)} USING (domain, lang, source) WHERE supply > 0 AND budget > 0),
placed AS (SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source
  ORDER BY md5('{seed}:' || epochs || ':' || key), key) AS run FROM rows JOIN plan USING (domain, lang, source))"""]
    return ("WITH " + ",\n".join(parts) + """
SELECT doc_id, domain, lang, source, n_rows, n_tokens, (epochs + (run <= rest)::INT)::BIGINT AS copies
FROM placed WHERE epochs + (run <= rest)::INT > 0""")
