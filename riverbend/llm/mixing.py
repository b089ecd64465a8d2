"""Mix sources to target weights.

Documents stand at the leaves of a tree, domain - language - source.  Every node has a weight among its siblings and a
capacity: its tokens times ``max_epochs``.  From the root down, a node's budget is dealt to its children by weight; a
child whose capacity is below its share gets its capacity and its shortage goes to its siblings by their weights.  As
a node's capacity is that of all its leaves, a shortage leaves a node only when all its siblings are full too, and is
then made up among the node's own siblings.

A leaf's budget is spent on epochs: whole passes over its documents, then a prefix of one more.  Each epoch has an
order of its own, by md5 of seed, epoch and id, and the prefix ends before the first document that would exceed the
budget.  So a leaf's choice is one number and one hash, and applying it to the documents needs no shuffle of texts.
Sums, shares and divisions are whole numbers; a node's remainder of fewer tokens than children isn't dealt.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import quoted, save

LEAF = ["domain", "lang", "source"]
#: Documents of a leaf are summed by the next digits of their hash, round by round, until the ones in which its budget
#: ends are so few that they can be put in order.
DIGITS, ORDERED = 2, 1 << 8


@dataclass(frozen=True)
class Mixture:
    """``domain`` is SQL over the source column ``source``; unnamed nodes have weight 1.  The whole mix has
    ``percent`` per cent of the tokens there are."""

    domain: str = "coalesce(concat('d', cast(try_cast(regexp_extract(source, '([0-9]+)$', 1) as bigint) % 4 as string)), 'other')"
    domains: dict[str, int] = field(default_factory=lambda: {"d0": 40, "d1": 30, "d2": 20, "d3": 10})
    languages: dict[str, int] = field(default_factory=lambda: {"en": 50, "de": 20, "fr": 20, "es": 10})
    sources: dict[str, int] = field(default_factory=dict)
    percent: int = 100
    max_epochs: int = 3
    seed: int = 17


def _weight(column: str, weights: dict[str, int]) -> Column:
    out = F.lit(1)
    for name, weight in weights.items():
        out = F.when(F.col(column) == name, weight).otherwise(out)
    return out.cast("long")


def place(docs: DataFrame, mixture: Mixture, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          source_col: str = "source", with_row: bool = False) -> DataFrame:
    """(id, domain, lang, source, n_tokens) of every document, and its whole row in ``row`` if asked.  Tokens are the
    words ``[^\\x20\\x09-\\x0D]+`` (null text: none); a null language or source is named ``und``."""
    row = [F.struct("*").alias("row")] if with_row else []
    d = docs.select(*row, F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.coalesce(lang_col, F.lit("und")).alias("lang"),
                    F.coalesce(source_col, F.lit("und")).alias("source"))
    return d.select(*(["row"] if with_row else []), "id", F.expr(mixture.domain).alias("domain"), "lang", "source",
                    F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long").alias("n_tokens"))


def _deal(nodes: DataFrame, parent: list[str], child: str) -> DataFrame:
    """``nodes`` with ``budget``: the parent's ``of`` dealt to children by ``weight`` up to their ``cap``.

    A child is full when the parent's budget fills all children to its own level, cap / weight.
    """
    exact = lambda c: F.col(c).cast("decimal(19,0)")
    siblings = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    level = siblings.orderBy(F.col("cap").cast("double") / F.col("weight"), child)
    below = F.coalesce(F.sum("cap").over(level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("long")
    above = F.sum("weight").over(level.rowsBetween(0, Window.unboundedFollowing))
    n = nodes.withColumn("below", below).withColumn("above", above)
    n = n.withColumn("full", exact("cap") * exact("above") <= (F.col("of") - F.col("below")).cast("decimal(19,0)") * exact("weight"))
    n = n.withColumn("left", F.col("of") - F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(siblings), F.lit(0)))
    n = n.withColumn("open", F.sum(F.when(~F.col("full"), F.col("weight"))).over(siblings))
    n = n.withColumn("budget", F.expr("if(full, cap, (cast(weight as decimal(19,0)) * cast(left as decimal(19,0))) div cast(open as decimal(19,0)))"))
    return n.drop("below", "above", "full", "left", "open", "of")


def budgets(placed: DataFrame, mixture: Mixture) -> DataFrame:
    """(domain, lang, source, tokens, budget, whole, rest): whole epochs and the tokens of one more, per leaf."""
    leaves = save(placed.groupBy(*LEAF).agg(F.sum("n_tokens").alias("tokens")).where("tokens > 0").withColumn(
        "cap", F.col("tokens") * mixture.max_epochs), "leaves")
    dealt = None
    for depth, weights in enumerate((mixture.domains, mixture.languages, mixture.sources)):
        parent, child = LEAF[:depth], LEAF[depth]
        nodes = leaves.groupBy(*parent, child).agg(F.sum("cap").alias("cap"), F.sum("tokens").alias("tokens")).withColumn("weight", _weight(child, weights))
        if dealt is None:
            everything = Window.partitionBy(F.lit(0))
            aim = F.expr(f"(sum(tokens) over (partition by 0) * {mixture.percent}) div 100")
            nodes = nodes.withColumn("of", F.least(aim, F.sum("cap").over(everything)))
        else:
            nodes = nodes.join(dealt.select(*parent, F.col("budget").alias("of")), parent)
        dealt = _deal(nodes.drop("tokens"), parent, child)
    return dealt.select(*LEAF, "budget").join(leaves.drop("cap"), LEAF).selectExpr(
        *LEAF, "tokens", "budget", "budget div tokens as whole", "budget % tokens as rest")


def order_hash(mixture: Mixture, epoch: Column, id_col: str) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(mixture.seed)), epoch.cast("string"), F.col(id_col).cast("string")))


def choices(placed: DataFrame, mixture: Mixture) -> DataFrame:
    """(domain, lang, source, whole, cut): a leaf's documents are taken in ``whole`` epochs, and once more where their
    hash in the epoch after is at most ``cut``.

    No leaf is put in order as a whole: its tokens are summed by hash prefix, and within the prefix in which the budget
    ends by longer prefixes, until ``ORDERED`` hashes at most are left to be ordered.  Rows with one hash (a repeated id,
    or none) are summed first; they are taken together or not at all.
    """
    leaves = save(budgets(placed, mixture), "budgets")
    hashed = placed.where("n_tokens > 0").join(leaves.where("rest > 0").select(*LEAF, "whole", "rest"), LEAF).select(
        *LEAF, "rest", "n_tokens", order_hash(mixture, F.col("whole"), "id").alias("h"))
    hashed = save(hashed.groupBy(*LEAF, "rest", "h").agg(F.sum("n_tokens").alias("n_tokens")), "hashed")
    last = leaves.where("rest > 0").select(*LEAF, F.lit("").alias("prefix"), F.lit(0).cast("long").alias("before"), F.lit(ORDERED + 1).cast("long").alias("n"))
    digits, small = 0, []
    while not last.isEmpty():
        digits += DIGITS
        open_ = hashed.withColumn("prefix", F.substring("h", 1, digits - DIGITS)).join(last.select(*LEAF, "prefix", "before"), [*LEAF, "prefix"])
        sums = open_.groupBy(*LEAF, "rest", "before", F.substring("h", 1, digits).alias("prefix")).agg(
            F.sum("n_tokens").alias("tokens"), F.count("*").alias("n"))
        lower = Window.partitionBy(*LEAF).orderBy("prefix").rowsBetween(Window.unboundedPreceding, -1)
        sums = sums.withColumn("before", F.col("before") + F.coalesce(F.sum("tokens").over(lower), F.lit(0)))
        found = save(sums.where("before <= rest and before + tokens > rest").select(*LEAF, "prefix", "before", "n"), "last")
        small.append(found.where(F.col("n") <= ORDERED).withColumn("digits", F.lit(digits)))
        last = found.where(F.col("n") > ORDERED)
    if not small:
        return save(leaves.select(*LEAF, "whole", F.lit(None).cast("string").alias("cut")), "choices")
    ends = reduce(DataFrame.unionByName, small)
    within = Window.partitionBy(*LEAF).orderBy("h")
    fits = hashed.join(ends, LEAF).where(F.substring("h", F.lit(1), F.col("digits")) == F.col("prefix"))
    fits = fits.withColumn("sum", F.col("before") + F.sum("n_tokens").over(within)).where("sum <= rest")
    cut = ends.join(fits.groupBy(*LEAF).agg(F.max("h").alias("h")), LEAF, "left").select(*LEAF, F.coalesce("h", "prefix").alias("cut"))
    return save(leaves.join(cut, LEAF, "left").select(*LEAF, "whole", "cut"), "choices")


def take(placed: DataFrame, chosen: DataFrame, mixture: Mixture) -> DataFrame:
    """The rows of ``placed`` that the choices take, one for each epoch, with column ``epoch`` from 1.  A document
    without tokens isn't taken."""
    joined = placed.where("n_tokens > 0").join(chosen, LEAF)
    more = F.coalesce(order_hash(mixture, F.col("whole"), "id") <= F.col("cut"), F.lit(False)).cast("int")
    return joined.withColumn("epoch", F.explode(F.expr("filter(sequence(0, int(whole) + 1), e -> e > 0)"))).where(
        F.col("epoch") <= F.col("whole") + more).drop("whole", "cut")


def mix(docs: DataFrame, mixture: Mixture | None = None) -> DataFrame:
    """(doc_id, domain, lang, source, n_tokens, epoch): a row for each document and epoch in which it is taken.

    Null ids, languages, sources and texts as in ``place`` and ``choices``; an empty table, or one without tokens, gives
    an empty one; other columns are not read.
    """
    mixture = mixture or Mixture()
    placed = save(place(docs, mixture), "placed")
    return take(placed, choices(placed, mixture), mixture).select(F.col("id").alias("doc_id"), *LEAF, "n_tokens", "epoch")


def mix_rows(docs: DataFrame, mixture: Mixture | None = None) -> DataFrame:
    """The rows that ``mix`` takes with all their columns, and ``domain``, ``n_tokens`` and ``epoch``; columns of those
    names in ``docs`` give way to them.  Texts aren't shuffled: the choices are one row for each leaf."""
    mixture = mixture or Mixture()
    chosen = choices(save(place(docs, mixture), "placed"), mixture)
    own = [c for c in docs.columns if c not in ("domain", "n_tokens", "epoch")]
    return take(place(docs, mixture, with_row=True), chosen, mixture).select(
        *(F.col(f"row.{quoted(c)}").alias(c) for c in own), "domain", "n_tokens", "epoch")
