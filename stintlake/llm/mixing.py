"""Mixing sources to target weights by hierarchical budgeting.

Documents are the leaves' rows of a tree root - domain - language - source. The token budget (SHARE of
all tokens) goes down the tree: the children of a node share its budget in proportion to their weights,
but none gets more than its capacity (EPOCHS times its tokens). What one child cannot use goes to its
siblings first; a node as a whole is capped by the sum below it, so only what all siblings together
cannot use reaches the node's own siblings.

The share of a child is least(capacity, level * weight), and the level that uses up the budget is the
largest of (budget - capacities before) / (weights from here on) over the children in ascending order
of capacity / weight.

A leaf takes whole epochs while its budget lasts, then the token-prefix of one more epoch: its rows in
the order of md5(seed, epoch, doc_id), each taken if the tokens before it are less than what is left.
The cut is found by refining the prefix of the order key digit pair by digit pair over sums, so no task
sorts the rows of a hot leaf. Rows with the same id stand at the same place and are taken together.

Null language or source is the child ''; a null or empty text has 0 tokens. An empty table gives an
empty result. The domain is an argument (a column of docs, null is the child ''); without it domain_of(source)
is taken, whatever columns docs has. The texts are read once to count their tokens, and rows without
texts are stored for the rest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stintlake.llm.scratch import keep

SHARE, EPOCHS, SEED = 0.8, 2, "mix-1"
#: Weights by level and node; nodes that aren't named have weight 1.
WEIGHTS = {"domain": {"web": 4, "books": 3, "code": 2}, "lang": {"en": 4, "de": 2, "fr": 2}, "source": {}}
LEVELS = ("domain", "lang", "source")
#: The cut points are sent to all tasks if the tree has at most so many leaves; else they are joined.
BROADCAST_LEAVES = 20_000


def domain_of(source: Column) -> Column:
    """An example of a tree's upper level: four domains by a digest of the source's name."""
    digit = F.substring(F.md5(source), 1, 1)
    return F.when(digit < "4", "web").when(digit < "8", "books").when(digit < "c", "code").otherwise("talk")


def token_count(text: Column) -> Column:
    """Estimated tokens: a quarter of the code points, rounded up."""
    return F.coalesce(F.floor((F.length(text) + 3) / 4), F.lit(0)).cast("long")


def leaf_columns(domain: Column | None = None) -> list[Column]:
    """The columns domain, lang and source of a row of documents."""
    source = F.coalesce("source", F.lit(""))
    domain = domain_of(source) if domain is None else F.coalesce(domain, F.lit(""))
    return [domain.alias("domain"), F.coalesce("lang", F.lit("")).alias("lang"), source.alias("source")]


def leaf_rows(docs: DataFrame, domain: Column | None = None) -> DataFrame:
    """doc_id, domain, lang, source, tokens of every row."""
    return docs.select("doc_id", *leaf_columns(domain), token_count(F.col("text")).alias("tokens"))


def _weight(level: str, weights: dict) -> Column:
    named = weights.get(level, {})
    out = F.lit(1.0)
    for node, w in sorted(named.items()):
        out = F.when(F.col(level) == node, F.lit(float(w))).otherwise(out)
    return out


def share_out(children: DataFrame, parent: list[str], level: str, weights: dict = WEIGHTS) -> DataFrame:
    """Adds `share` to siblings with columns parent, level, capacity and budget (of their parent)."""
    whole = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    line = whole.orderBy(F.col("capacity") / F.col("_w"), level)
    df = children.withColumn("_w", _weight(level, weights))
    before = F.coalesce(F.sum("capacity").over(line.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    onward = F.sum("_w").over(line.rowsBetween(0, Window.unboundedFollowing))
    df = df.withColumn("_level", (F.col("budget") - before) / onward)
    return df.withColumn("share", F.least("capacity", F.max("_level").over(whole) * F.col("_w"))).drop("_w", "_level")


def leaf_budgets(leaves: DataFrame, share: float = SHARE, epochs: int = EPOCHS, weights: dict = WEIGHTS) -> DataFrame:
    """Leaves (domain, lang, source, tokens) with their whole epochs `full` and what is left, `rest`."""
    leaves = leaves.where("tokens > 0").withColumn("capacity", F.col("tokens").cast("double") * epochs)
    total = leaves.agg(F.floor(F.sum("tokens").cast("double") * share).cast("double").alias("budget"))
    above, parent = total, []
    for k, level in enumerate(LEVELS):
        nodes = leaves.groupBy(*LEVELS[: k + 1]).agg(F.sum("capacity").alias("capacity"))
        nodes = nodes.join(above, parent) if parent else nodes.crossJoin(F.broadcast(above))  # one row
        parent = list(LEVELS[: k + 1])
        above = share_out(nodes, parent[:-1], level, weights).select(*parent, F.col("share").alias("budget"))
    out = leaves.join(above, list(LEVELS)).withColumn("budget", F.floor(F.col("budget") + F.lit(1e-6)).cast("long"))
    out = out.withColumn("full", F.floor(F.col("budget") / F.col("tokens")).cast("long"))
    return out.select(*LEVELS, "full", (F.col("budget") - F.col("full") * F.col("tokens")).alias("rest"))


def order_key(full: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(SEED), full.cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))


def cut_points(rows: DataFrame) -> tuple[DataFrame, bool]:
    """(domain, lang, source, full, cut) of each leaf, and whether the leaves are few enough to be sent
    to all tasks. The rows up to `cut` in the order of epoch `full` are its prefix (null: none)."""
    leaves = rows.groupBy(*LEVELS).agg(F.sum("tokens").alias("tokens"))
    few = leaves.limit(BROADCAST_LEAVES + 1).count() <= BROADCAST_LEAVES
    # each state is used twice, so it is stored: else the plan doubles with every step
    store = lambda df: keep(df.repartition(1) if few else df)  # noqa: E731  a row a leaf, few are one file
    state = store(leaf_budgets(leaves).withColumns({"prefix": F.lit(""), "before": F.lit(0).cast("long")}))
    leaf = Window.partitionBy(*LEVELS)
    for digits in (2, 4, 32):
        near = rows.join(F.broadcast(state) if few else state, list(LEVELS)).withColumn("_key", order_key(F.col("full"))).where("rest > 0 AND startswith(_key, prefix)")
        sums = near.groupBy(*LEVELS, "full", "rest", F.substring("_key", 1, digits).alias("prefix")).agg(F.min("before").alias("_from"), F.sum("tokens").alias("_tokens"))
        sums = sums.withColumn("before", F.col("_from") + F.sum("_tokens").over(leaf.orderBy("prefix").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_tokens"))
        last = sums.where("before < rest").groupBy(*LEVELS).agg(F.max(F.struct("prefix", "before")).alias("_x"))
        state = store(state.select(*LEVELS, "full", "rest").join(last, list(LEVELS), "left").select(*LEVELS, "full", "rest", F.col("_x.prefix").alias("prefix"), F.col("_x.before").alias("before")))
    return state.select(*LEVELS, "full", F.col("prefix").alias("cut")), few


def mix(docs: DataFrame, domain: Column | None = None) -> DataFrame:
    """doc_id, domain, lang, source, tokens, copies of every row that is taken at least once."""
    rows = keep(leaf_rows(docs, domain))
    state, few = cut_points(rows)
    taken = rows.join(F.broadcast(state) if few else state, list(LEVELS))
    copies = F.col("full") + F.coalesce((order_key(F.col("full")) <= F.col("cut")).cast("long"), F.lit(0))
    return taken.withColumn("copies", copies).where("copies > 0").select("doc_id", *LEVELS, "tokens", "copies")


def take(docs: DataFrame, domain: Column | None = None) -> DataFrame:
    """The rows of docs, each as often as the mixture takes it, with the columns of docs."""
    state, few = cut_points(keep(leaf_rows(docs, domain)))
    # the row travels as one struct, so its columns may have any names
    keyed = docs.select("doc_id", F.struct(*leaf_columns(domain)).alias("_leaf"), F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    state = state.select(F.struct(*LEVELS).alias("_leaf"), F.col("full").alias("_full"), F.col("cut").alias("_cut"))
    joined = keyed.join(F.broadcast(state) if few else state, "_leaf")
    copies = F.col("_full") + F.coalesce((order_key(F.col("_full")) <= F.col("_cut")).cast("long"), F.lit(0))
    again = joined.withColumn("_copies", copies).where("_copies > 0")
    return again.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int")))).select("row.*")


_TREE = ", ".join(LEVELS)


def _share_sql(name: str, parent: tuple[str, ...], level: str, above: str) -> str:
    weight = "CASE " + " ".join(f"WHEN {level} = '{n}' THEN {float(w)}" for n, w in sorted(WEIGHTS[level].items())) + " ELSE 1.0 END" if WEIGHTS[level] else "1.0"
    cols = ", ".join([*parent, level])
    by = f"PARTITION BY {', '.join(parent)}" if parent else ""
    join = f"JOIN {above} USING ({', '.join(parent)})" if parent else f"CROSS JOIN {above}"
    return f"""{name}_n AS (SELECT {cols}, sum(capacity) AS capacity, CAST({weight} AS DOUBLE) AS w FROM leaves GROUP BY {cols}),
{name}_l AS (SELECT n.*, budget, (budget - coalesce(sum(capacity) OVER ({by} ORDER BY capacity / w, {level} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
  / sum(w) OVER ({by} ORDER BY capacity / w, {level} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lv FROM {name}_n n {join}),
{name} AS (SELECT {cols}, least(capacity, max(lv) OVER ({by}) * w) AS budget FROM {name}_l)"""


ORACLE_SQL = f"""
WITH rows_ AS (
  SELECT doc_id, CASE WHEN substr(md5(coalesce(source, '')), 1, 1) < '4' THEN 'web' WHEN substr(md5(coalesce(source, '')), 1, 1) < '8' THEN 'books'
    WHEN substr(md5(coalesce(source, '')), 1, 1) < 'c' THEN 'code' ELSE 'talk' END AS domain,
    coalesce(lang, '') AS lang, coalesce(source, '') AS source, CAST(coalesce((length(text) + 3) // 4, 0) AS BIGINT) AS tokens FROM documents),
leaves AS (SELECT {_TREE}, CAST(sum(tokens) AS BIGINT) AS tokens, CAST(sum(tokens) AS DOUBLE) * {EPOCHS} AS capacity FROM rows_ GROUP BY {_TREE} HAVING sum(tokens) > 0),
total AS (SELECT floor(CAST(sum(tokens) AS DOUBLE) * CAST({SHARE} AS DOUBLE)) AS budget FROM leaves),
{_share_sql("domains", (), "domain", "total")},
{_share_sql("langs", ("domain",), "lang", "domains")},
{_share_sql("sources", ("domain", "lang"), "source", "langs")},
state AS (SELECT l.*, CAST(floor(s.budget + CAST(1e-6 AS DOUBLE)) AS BIGINT) AS b FROM leaves l JOIN sources s USING ({_TREE})),
epochs AS (SELECT {_TREE}, b // tokens AS full_, b - (b // tokens) * tokens AS rest FROM state),
keyed AS (SELECT r.*, full_, rest, md5('{SEED}:' || full_ || ':' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS k FROM rows_ r JOIN epochs USING ({_TREE})),
units AS (SELECT {_TREE}, k, sum(tokens) AS t FROM keyed GROUP BY {_TREE}, k),
placed AS (SELECT {_TREE}, k, sum(t) OVER (PARTITION BY {_TREE} ORDER BY k ROWS UNBOUNDED PRECEDING) - t AS before FROM units)
SELECT doc_id, {_TREE}, tokens, CAST(full_ + CASE WHEN before < rest THEN 1 ELSE 0 END AS BIGINT) AS copies
FROM keyed JOIN placed USING ({_TREE}, k) WHERE full_ + CASE WHEN before < rest THEN 1 ELSE 0 END > 0
"""
