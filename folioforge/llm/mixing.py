"""Mixing sources to target weights by hierarchical budgeting.

Weights flow from a token budget down a tree of domain, language and source. A node can't take more than what its
leaves hold over `epochs` passes; what it can't take goes to its siblings by their weights, and only what all of them
together can't take goes to the siblings of their parent. Each leaf then takes a prefix of its documents in a seeded
order, anew for each epoch, as long as the prefix's tokens stay within the budget.

Levels are shared out by windows over one row a node; a prefix is a threshold on the seeded order, found from totals
of the order's buckets (256 a leaf), of the parts of one bucket, and the rows of one part. No leaf meets in one task, and no text is shuffled.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import durable, fresh, keyed

#: Target weights of production: whole numbers by name; names not listed have DEFAULT_WEIGHT.
DOMAIN_WEIGHTS = {"web": 5, "books": 3, "code": 2, "forum": 1}
LANGUAGE_WEIGHTS = {"en": 6, "de": 2, "fr": 2, "es": 1}
SOURCE_WEIGHTS: dict[str, int] = {}
DEFAULT_WEIGHT = 1
SEED = 20240601
#: Leaf tables up to so many rows are broadcast, larger ones are joined by a shuffle of narrow rows.
MAX_BROADCAST_LEAVES = 10_000
_LEVELS = ("domain", "lang", "source")


def domain_of(source: Column, domains: Mapping[str, str] | None = None) -> Column:
    """The domain of a source: that of a map by name, if one is given; else by rule, from the first digit of the MD5 of its name."""
    if domains:
        return F.coalesce(F.create_map(*[F.lit(x) for pair in sorted(domains.items()) for x in pair])[source], F.lit("other"))
    digit = F.substring(F.md5(F.coalesce(source, F.lit(""))), 1, 1)
    return F.when(digit < "4", "web").when(digit < "8", "books").when(digit < "c", "code").otherwise("forum")


def count_tokens(text: Column) -> Column:
    """Words: runs of characters but ASCII white space. A null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def seeded(seed: int, epoch: Column, key: Column) -> Column:
    """The place of a document in an epoch's order."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), key.cast("string")))


def _weight(level: Column, weights: Mapping[str, int]) -> Column:
    out = F.lit(DEFAULT_WEIGHT)
    for name, w in weights.items():
        if w <= 0:
            raise ValueError("weights are positive whole numbers")
        out = F.when(level == name, w).otherwise(out)
    return out.cast("decimal(38,0)")


def share(nodes: DataFrame, parents: list[str], order: list[str]) -> DataFrame:
    """Split `given` among the nodes of a parent by `weight`, no node above its `capacity`: adds `budget`.

    In the order of capacity per weight, a node is full if all before it are and its own capacity is within its share
    of what they leave; the others share the rest by weight, rounded down. All columns are whole numbers. So a parent hands
    on less than a token a child too little, which stays unused: budgets add up to the total but for a token a node at most.
    """
    ratio = (F.col("capacity") / F.col("weight")).cast("decimal(38,12)")
    ranked = nodes.withColumn("ratio", ratio)
    upward = Window.partitionBy(*parents).orderBy("ratio", *order)
    before = upward.rowsBetween(Window.unboundedPreceding, -1)
    onward = upward.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    left = ranked.withColumns({"left": F.col("given") - F.coalesce(F.sum("capacity").over(before), F.lit(0)), "weights": F.sum("weight").over(onward)})
    fits = left.withColumn("full", F.expr("left > 0 and capacity * weights <= left * weight"))
    # Once a node isn't full, none after it is; the first such node tells what is left for all of them.
    rest = Window.partitionBy(*parents, "full")
    shared = fits.withColumns({"pool": F.max("left").over(rest), "pool_weights": F.max("weights").over(rest)})
    budget = F.when(F.col("full"), F.col("capacity")).otherwise(F.greatest(F.lit(0), F.expr("cast(pool * weight div pool_weights as decimal(38,0))")))
    return shared.withColumn("budget", F.least("capacity", budget).cast("decimal(38,0)")).drop("ratio", "left", "weights", "full", "pool", "pool_weights")


def leaf_budgets(leaves: DataFrame, total: int, epochs: int, weights: tuple[Mapping[str, int], Mapping[str, int], Mapping[str, int]] = (DOMAIN_WEIGHTS, LANGUAGE_WEIGHTS, SOURCE_WEIGHTS)) -> DataFrame:
    """Budgets of leaves (domain, lang, source, supply), one row each, from a total number of tokens."""
    out = leaves.withColumns({"capacity_3": (F.col("supply") * epochs).cast("decimal(38,0)"), "top": F.lit(0)})
    for k in (2, 1):
        out = out.withColumn(f"capacity_{k}", F.sum("capacity_3").over(Window.partitionBy(*_LEVELS[:k])).cast("decimal(38,0)"))
    given, budgets = None, None
    for k, level in enumerate(_LEVELS, 1):
        names = list(_LEVELS[:k])
        nodes = out.select("top", *names, F.col(f"capacity_{k}").alias("capacity")).distinct().withColumn("weight", _weight(F.col(level), weights[k - 1]))
        if budgets is None:
            nodes = nodes.withColumn("given", F.lit(total).cast("decimal(38,0)"))
        else:
            up = budgets.select(*[F.col(n).alias(f"up_{n}") for n in given], F.col("budget").alias("given"))
            same = None
            for n in given:
                test = F.col(n).eqNullSafe(F.col(f"up_{n}"))
                same = test if same is None else same & test
            nodes = nodes.join(up, same).drop(*[f"up_{n}" for n in given])
        budgets, given = share(nodes, ["top", *names[:-1]], [level]), names
    return budgets.select(*_LEVELS, F.col("budget").cast("long").alias("budget"), (F.col("capacity") / epochs).cast("long").alias("supply"))


def select_prefixes(docs: DataFrame, budget_share: tuple[int, int] = (3, 4), epochs: int = 2, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source", bucket_digits: int = 2, domains: Mapping[str, str] | None = None):
    """(narrow rows, leaf table): what mix() and keep_mixed() apply. budget_share is the budget as a part of all tokens."""
    text, source = F.col(f"`{text_col}`").cast("string"), F.col(f"`{source_col}`").cast("string")
    rows = durable(docs.select(keyed(id_col, text_col).alias("key"), F.col(f"`{id_col}`").cast("long").alias("doc_id"), domain_of(source, domains).alias("domain"), F.col(f"`{lang_col}`").cast("string").alias("lang"), source.alias("source"), count_tokens(text).alias("n_tokens")))
    leaves = durable(rows.groupBy(*_LEVELS).agg(F.sum("n_tokens").cast("decimal(38,0)").alias("supply")))
    n, supply = leaves.agg(F.count("*"), F.coalesce(F.sum("supply"), F.lit(0))).first()
    budgets = durable(
        leaf_budgets(leaves, int(supply) * budget_share[0] // budget_share[1], epochs)
        .withColumn("full", F.when(F.col("supply") > 0, F.expr("budget div supply")).otherwise(F.lit(0)))
        .withColumn("rest", F.col("budget") - F.col("full") * F.col("supply"))
        .withColumn("leaf", F.struct(*_LEVELS))
        .select("leaf", "budget", "full", "rest")
    )
    small = n <= MAX_BROADCAST_LEAVES

    def with_leaf(df: DataFrame, table: DataFrame) -> DataFrame:
        return df.join(F.broadcast(table) if small else table, "leaf")

    placed = with_leaf(rows.withColumn("leaf", F.struct(*_LEVELS)), budgets).withColumn("place", seeded(seed, F.col("full"), F.col("key")))
    # The first bucket of the order that doesn't fit whole, at most one a leaf; then the first such part of that bucket.
    edge = None
    for digits in range(bucket_digits, 2 * bucket_digits + 1, bucket_digits):
        open_ = placed.withColumn("before", F.lit(0).cast("long")) if edge is None else with_leaf(placed, edge).where(F.substring("place", 1, digits - bucket_digits) == F.col("bucket"))
        sums = open_.groupBy("leaf", "rest", "before", F.substring("place", 1, digits).alias("part")).agg(F.sum("n_tokens").alias("n"))
        running = F.sum("n").over(Window.partitionBy("leaf").orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow))
        over = sums.withColumn("upto", F.col("before") + running).where("upto > rest")
        edge = durable(over.groupBy("leaf").agg(F.min(F.struct("part", (F.col("upto") - F.col("n")).alias("before"))).alias("edge")).select("leaf", F.col("edge.part").alias("bucket"), "edge.before"))
    inside = with_leaf(placed, edge).where(F.substring("place", 1, 2 * bucket_digits) == F.col("bucket"))
    within = Window.partitionBy("leaf").orderBy("place")  # rows of the same place are taken or left together
    cut = inside.withColumn("upto", F.col("before") + F.sum("n_tokens").over(within)).where("upto <= rest").groupBy("leaf").agg(F.max("place").alias("last_place"))
    table = budgets.join(edge, "leaf", "left").join(cut, "leaf", "left").select("leaf", "full", F.when(F.col("bucket").isNull(), F.lit("g")).otherwise(F.coalesce("last_place", "bucket")).alias("last_place"))
    return rows, durable(table), with_leaf


def _epochs_of(seed: int, key: Column) -> Column:
    """All whole epochs, then the one begun if the document is in its prefix."""
    taken = seeded(seed, F.col("full"), key) <= F.col("last_place")
    return F.concat(F.when(F.col("full") > 0, F.expr("sequence(0L, full - 1)")).otherwise(F.array().cast("array<long>")), F.when(taken, F.array(F.col("full").cast("long"))).otherwise(F.array().cast("array<long>")))


def mix(docs: DataFrame, budget_share: tuple[int, int] = (3, 4), epochs: int = 2, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source", domains: Mapping[str, str] | None = None) -> DataFrame:
    """One row for each document and epoch that it is taken in: doc_id, domain, lang, source, n_tokens, epoch.

    Null languages and sources are leaves of their own. A text without a word takes no budget: it is taken with the
    prefix its place lies in. Repeated rows lie at one place and are taken or left together. Other columns are not read.
    """
    rows, table, with_leaf = select_prefixes(docs, budget_share, epochs, seed, id_col, text_col, lang_col, source_col, domains=domains)
    taken = with_leaf(rows.withColumn("leaf", F.struct(*_LEVELS)), table)
    return taken.select("doc_id", *_LEVELS, "n_tokens", F.explode(_epochs_of(seed, F.col("key"))).alias("epoch"))


def keep_mixed(docs: DataFrame, budget_share: tuple[int, int] = (9, 10), seed: int = SEED, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source", domains: Mapping[str, str] | None = None) -> DataFrame:
    """The rows of docs, all columns as they are, that one epoch takes."""
    _, table, _ = select_prefixes(docs, budget_share, 1, seed, id_col, text_col, lang_col, source_col, domains=domains)
    full, last, key, d, l, s = fresh(docs, "full", "last_place", "row_key", "leaf_domain", "leaf_lang", "leaf_source")
    flat = table.select(F.col("leaf.domain").alias(d), F.col("leaf.lang").alias(l), F.col("leaf.source").alias(s), F.col("full").alias(full), F.col("last_place").alias(last))
    source = F.col(f"`{source_col}`").cast("string")
    same = (domain_of(source, domains) == F.col(d)) & F.col(f"`{lang_col}`").cast("string").eqNullSafe(F.col(l)) & source.eqNullSafe(F.col(s))
    joined = docs.withColumn(key, keyed(id_col, text_col)).join(F.broadcast(flat) if flat.count() <= MAX_BROADCAST_LEAVES else flat, same)
    taken = (F.col(full) > 0) | (seeded(seed, F.col(full), F.col(key)) <= F.col(last))
    return joined.where(taken).select(*[f"`{c}`" for c in docs.columns])
