"""Mixing sources to target weights by hierarchical budgeting.

The corpus is a tree domain > language > source whose leaves hold documents.  A
token budget goes down the tree: a node splits its budget among its children in
proportion to their weights, a child that cannot take its share (its tokens
times ``max_epochs``) is filled, and what it leaves goes to its siblings by
weight.  A node's capacity is the sum of its leaves', so a shortage reaches an
ancestor's other children only when all siblings are full.  The split of one
node is closed-form (a running sum over children sorted by capacity / weight),
so each level is one window over the children.

A leaf's budget is spent in epochs.  Whole epochs take all its documents; the
last takes a token-prefix of the order md5(seed:epoch:doc_id).  The prefix ends
at one key per leaf, found in two steps (4,096 key buckets, then inside one
bucket), so a leaf with a third of the corpus is never sorted as a whole.

Defined results: null texts have no tokens, null languages and sources are '',
rows of one doc_id in a leaf are taken together; documents without tokens are
taken with the prefix they fall in; leaves without tokens, and children of
weight 0, get nothing; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.llm.base import fresh, pick, register, stored, table, words

LEAF = ["domain", "lang", "source"]
SEED = 17
BUDGET_SHARE = 0.6          # of the corpus's tokens
MAX_EPOCHS = 2
#: Target weights; what is not listed has weight ``DEFAULT_WEIGHT``.
DOMAINS = {"web": ("src0", "src1", "src2", "src3", "src4", "src5", "src6", "src7"),
           "books": ("src8", "src9", "src10", "src11", "src12"),
           "reference": ("src13", "src14", "src15", "src16")}
OTHER_DOMAIN = "forum"
DOMAIN_WEIGHTS = {"web": 0.3, "books": 0.3, "reference": 0.25, "forum": 0.15}
LANG_WEIGHTS = {"en": 0.4, "de": 0.2, "fr": 0.2, "es": 0.2}
SOURCE_WEIGHTS = {"src0": 2.0, "src8": 2.0}
DEFAULT_WEIGHT = 1.0


def domain_of(source: Column, domains=DOMAINS, other: str = OTHER_DOMAIN) -> Column:
    out = F.lit(other)
    for name, sources in domains.items():
        out = F.when(source.isin(*sources), F.lit(name)).otherwise(out)
    return out


def _weight(col: str, weights: dict[str, float]) -> Column:
    out = F.lit(DEFAULT_WEIGHT)
    for k, w in weights.items():
        out = F.when(F.col(col) == k, F.lit(float(w))).otherwise(out)
    return out


def split_budget(children: DataFrame, parent: list[str]) -> DataFrame:
    """Adds ``budget``: each parent's ``given`` split over its children (columns
    weight, capacity) in proportion to weight, shortages going to siblings."""
    # a constant key keeps the root's window well-defined; it has one row per domain
    keys = [F.col(c) for c in parent] or [F.lit(0)]
    order = Window.partitionBy(*keys).orderBy(F.col("capacity") / F.col("weight"), *[c for c in LEAF if c in children.columns])
    run = order.rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*keys)
    left = F.col("given") - (F.sum("capacity").over(run) - F.col("capacity"))
    weight = F.sum("weight").over(whole) - F.sum("weight").over(run) + F.col("weight")
    level = children.where("weight > 0 and capacity > 0").withColumn("level", left / weight)
    open_ = F.when(F.col("capacity") / F.col("weight") > F.col("level"), F.col("level"))
    level = level.withColumn("top", F.max(open_).over(whole))
    return level.withColumn("budget", F.when(F.col("top").isNull(), F.col("capacity")).otherwise(
        F.least("capacity", F.col("top") * F.col("weight")))).drop("level", "top")


def leaf_budgets(leaves: DataFrame, budget_share: float, max_epochs: int, domain_weights=DOMAIN_WEIGHTS,
                 lang_weights=LANG_WEIGHTS, source_weights=SOURCE_WEIGHTS) -> DataFrame:
    """domain, lang, source, tokens, budget for every leaf (column tokens) that gets any."""
    leaves = leaves.withColumn("capacity", F.col("tokens") * float(max_epochs))
    root = Window.partitionBy(F.lit(0))             # over one row per domain
    nodes = None
    for depth, weights in ((1, domain_weights), (2, lang_weights), (3, source_weights)):
        parent, here = LEAF[:depth - 1], LEAF[:depth]
        sums = leaves.groupBy(*here).agg(F.sum("capacity").alias("capacity"), F.sum("tokens").alias("tokens"))
        sums = sums.withColumn("weight", _weight(here[-1], weights))
        if nodes is None:
            sums = sums.withColumn("given", F.sum("tokens").over(root) * budget_share)
        else:
            sums = sums.join(nodes.select(*parent, F.col("budget").alias("given")), parent)
        nodes = split_budget(sums, parent)
    return nodes.select(*LEAF, "tokens", "budget")


def draw_key(epoch: Column, doc_id: Column, seed: int = SEED) -> Column:
    """The document's place in the seeded order of an epoch."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit(""))))


def leaf_cuts(docs: DataFrame, budgets: DataFrame, seed: int = SEED) -> DataFrame:
    """domain, lang, source, budget, full (whole epochs), cut (largest key of the next epoch)."""
    b = budgets.withColumn("full", F.floor(F.col("budget") / F.col("tokens") + 1e-9).cast("int"))
    b = b.withColumn("rest", F.greatest(F.col("budget") - F.col("full") * F.col("tokens"), F.lit(0.0)))
    keyed = docs.join(b, LEAF).select(*LEAF, "full", "rest", "n_tokens", draw_key(F.col("full"), F.col("doc_id"), seed).alias("key"))
    keyed = keyed.withColumn("bucket", F.substring("key", 1, 3))
    up = Window.partitionBy(*LEAF).orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    buckets = keyed.groupBy(*LEAF, "rest", "bucket").agg(F.sum("n_tokens").alias("n"))
    buckets = buckets.withColumn("upto", F.sum("n").over(up))
    # the first bucket that does not fit as a whole holds the end of the prefix
    edge = (buckets.where("upto > rest").groupBy(*LEAF)
            .agg(F.min(F.struct("bucket", (F.col("upto") - F.col("n")).alias("before"))).alias("e"))
            .select(*LEAF, F.col("e.bucket").alias("bucket"), F.col("e.before").alias("before")))
    inner = (keyed.join(edge, [*LEAF, "bucket"]).groupBy(*LEAF, "rest", "before", "key").agg(F.sum("n_tokens").alias("n")))
    by_key = Window.partitionBy(*LEAF).orderBy("key").rowsBetween(Window.unboundedPreceding, 0)
    fits = inner.withColumn("upto", F.col("before") + F.sum("n").over(by_key)).where("upto <= rest")
    last = fits.groupBy(*LEAF).agg(F.max("key").alias("last"))
    return (b.join(edge.select(*LEAF, "bucket"), LEAF, "left").join(last, LEAF, "left")
            .select(*LEAF, "budget", "full", F.coalesce("last", "bucket", F.lit("")).alias("cut")))


def token_table(docs: DataFrame, id_col="doc_id", text_col="text", lang_col="lang", source_col="source") -> DataFrame:
    """doc_id, domain, lang, source, n_tokens (words of the whole text)."""
    src = pick(docs, doc_id=id_col, text=text_col, lang=lang_col, source=source_col)
    return src.select("doc_id", domain_of(F.coalesce("source", F.lit(""))).alias("domain"),
                      F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source"),
                      F.size(words(F.col("text"))).cast("long").alias("n_tokens"))


def _plan(tokens: DataFrame, budget_share: float, max_epochs: int, seed: int) -> DataFrame:
    leaves = tokens.groupBy(*LEAF).agg(F.sum("n_tokens").alias("tokens"))
    return leaf_cuts(tokens, leaf_budgets(leaves, budget_share, max_epochs), seed)


def _epochs(doc_id: Column, seed: int) -> Column:
    """The epochs that take a row joined with its leaf's (full, cut)."""
    n = F.col("full") + (draw_key(F.col("full"), doc_id, seed) <= F.col("cut")).cast("int")
    return F.filter(F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1), lambda e: e < n)


def mix(docs: DataFrame, budget_share: float = BUDGET_SHARE, max_epochs: int = MAX_EPOCHS, seed: int = SEED,
        **cols) -> DataFrame:
    """doc_id, domain, lang, source, epoch, n_tokens, leaf_budget: a row for each time a document is drawn."""
    tokens = stored(token_table(docs, **cols), "mix-tokens")
    cuts = stored(_plan(tokens, budget_share, max_epochs, seed), "mix-cuts")
    return (tokens.join(cuts, LEAF)
            .select("doc_id", *LEAF, F.explode(_epochs(F.col("doc_id"), seed)).alias("epoch"), "n_tokens", "budget")
            .select("doc_id", *LEAF, F.col("epoch").cast("long").alias("epoch"), "n_tokens",
                    F.round("budget", 2).alias("leaf_budget")))


def select_mix(docs: DataFrame, budget_share: float = BUDGET_SHARE, max_epochs: int = 1, seed: int = SEED) -> DataFrame:
    """``docs`` itself, each row as often as it is drawn, with its own columns only."""
    tokens = stored(token_table(docs), "mix-tokens")
    cuts = stored(_plan(tokens, budget_share, max_epochs, seed), "mix-cuts")
    cuts = cuts.select(*[F.col(c).alias(fresh(docs, f"leaf_{c}")) for c in LEAF], F.col("full").alias(fresh(docs, "full")),
                       F.col("cut").alias(fresh(docs, "cut")))
    leaf, full, cut = cuts.columns[:3], cuts.columns[3], cuts.columns[4]
    source = F.coalesce(docs["source"], F.lit(""))
    on = ((domain_of(source) == cuts[leaf[0]]) & (F.coalesce(docs["lang"], F.lit("")) == cuts[leaf[1]])
          & (source == cuts[leaf[2]]))
    n = cuts[full] + (draw_key(cuts[full], docs["doc_id"], seed) <= cuts[cut]).cast("int")
    epochs = F.filter(F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1), lambda e: e < n)
    name = fresh(docs, "epoch")
    return docs.join(cuts, on).select(*[docs[c] for c in docs.columns], F.explode(epochs).alias(name)).drop(name)


def _case(col: str, weights: dict[str, float]) -> str:
    return f"CASE {col} " + " ".join(f"WHEN '{k}' THEN {float(w)}" for k, w in weights.items()) + f" ELSE {DEFAULT_WEIGHT} END"


_DOMAIN = "CASE " + " ".join("WHEN source IN ({}) THEN '{}'".format(", ".join(f"'{s}'" for s in ss), d)
                             for d, ss in DOMAINS.items()) + f" ELSE '{OTHER_DOMAIN}' END"


def _split_sql(name: str, given: str, here: str, weight: str, parent: str) -> str:
    by = f"PARTITION BY {parent}" if parent else ""
    return f"""
{name}_c AS (SELECT * FROM (SELECT n.*, {weight} AS w, g.given FROM (
    SELECT {here}, sum(cap) AS cap, sum(tokens) AS tokens FROM leaves GROUP BY {here}) n JOIN {given}) WHERE w > 0 AND cap > 0),
{name}_l AS (SELECT *, (given - (sum(cap) OVER r - cap)) / (sum(w) OVER a - sum(w) OVER r + w) AS lev FROM {name}_c
    WINDOW a AS ({by}), r AS ({by} ORDER BY cap / w, {here} ROWS UNBOUNDED PRECEDING)),
{name} AS (SELECT *, CASE WHEN top IS NULL THEN cap ELSE least(cap, top * w) END AS budget FROM (
    SELECT *, max(CASE WHEN cap / w > lev THEN lev END) OVER ({by}) AS top FROM {name}_l))"""


ORACLE_SQL = f"""
WITH d AS (SELECT doc_id, {_DOMAIN} AS domain, lang, source, n_tokens FROM (
    SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS n_tokens FROM documents)),
leaves AS (SELECT domain, lang, source, sum(n_tokens)::DOUBLE AS tokens, sum(n_tokens) * {float(MAX_EPOCHS)} AS cap
           FROM d GROUP BY ALL),
root AS (SELECT sum(tokens) * {BUDGET_SHARE} AS given FROM leaves),
{_split_sql("l1", "root g ON true", "domain", _case("domain", DOMAIN_WEIGHTS), "")},
{_split_sql("l2", "(SELECT domain, budget AS given FROM l1) g USING (domain)", "domain, lang", _case("lang", LANG_WEIGHTS), "domain")},
{_split_sql("l3", "(SELECT domain, lang, budget AS given FROM l2) g USING (domain, lang)", "domain, lang, source",
            _case("source", SOURCE_WEIGHTS), "domain, lang")},
b AS (SELECT domain, lang, source, tokens, budget, floor(budget / tokens + 1e-9) AS whole FROM l3),
k AS (SELECT d.*, budget, whole, greatest(budget - whole * tokens, 0) AS rest,
             md5('{SEED}:' || cast(whole AS INT) || ':' || coalesce(cast(doc_id AS VARCHAR), '')) AS key
      FROM d JOIN b USING (domain, lang, source)),
c AS (SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY key) AS upto FROM k)
SELECT doc_id, domain, lang, source, cast(e AS BIGINT) AS epoch, cast(n_tokens AS BIGINT) AS n_tokens, round(budget, 2) AS leaf_budget
FROM (SELECT *, unnest(range(0, cast(whole AS BIGINT) + CASE WHEN upto <= rest THEN 1 ELSE 0 END)) AS e FROM c)
"""


@register("op9_mixing", ORACLE_SQL)
def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))
