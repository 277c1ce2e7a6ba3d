"""Mixing sources: budgets down a tree of domains, languages and sources, then documents for them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.shared import attach, settled

LEVELS = ("domain", "lang", "source")
#: Hex digits of the order that cut a leaf into stretches (4,096 of them), of which
#: only one, where the budget ends, is summed row by row.
STRETCH_DIGITS = 3
#: The plan of so many leaves is sent to all tasks; that of more is joined by a shuffle.
SENT_LEAVES = 100_000


def _shared_out(nodes: DataFrame, parent: list[str], name: str) -> DataFrame:
    """``budget`` of each node from ``given``, that of its parent, by ``weight`` and ``capacity``.

    What a node cannot take goes to its siblings in proportion to their weights,
    until all that is given is placed or all are full: those which fill up at the
    smallest amount for a unit of weight are served first.
    """
    siblings = Window.partitionBy(*parent)
    by_need = siblings.orderBy(F.col("capacity") / F.col("weight"), name)
    before = by_need.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_need.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    left = F.col("given") - F.coalesce(F.sum("capacity").over(before), F.lit(0))
    ranked = nodes.withColumns({"left": left, "weights": F.sum("weight").over(rest)})
    ranked = ranked.withColumn("full", F.col("left") * F.col("weight") >= F.col("capacity") * F.col("weights"))
    # What is left once all full nodes have been served, and the weights that share it.
    served = F.coalesce(F.sum(F.when(F.col("full"), F.col("capacity"))).over(siblings), F.lit(0))
    ranked = ranked.withColumns({
        "open_left": F.col("given") - served,
        "open_weights": F.sum(F.when(~F.col("full"), F.col("weight"))).over(siblings),
    })
    budget = F.when(F.col("full"), F.col("capacity")).otherwise(F.expr("open_left * weight div open_weights"))
    return ranked.withColumn("budget", budget)


def budgets(leaves: DataFrame, share: tuple[int, int], max_epochs: int) -> DataFrame:
    """``leaves`` with ``budget``, in tokens.

    ``leaves``: ``domain, lang, source, tokens`` and whole weights above 0,
    ``domain_weight, lang_weight, source_weight``, the same for all leaves of a node.
    The root gets ``share`` (a fraction) of all tokens; a node takes ``max_epochs``
    times its own at most.  Going down, a shortage stays as near as it can: what a
    source cannot take goes to the sources of the same language and domain, what
    these cannot to the other languages of the domain, then to the other domains.
    Rounding down loses less than a token for each node.
    """
    given = None
    for depth, level in enumerate(LEVELS, start=1):
        path = list(LEVELS[:depth])
        nodes = leaves.groupBy(*path).agg(
            F.sum("tokens").alias("tokens"), F.sum(F.col("tokens") * max_epochs).alias("capacity"),
            F.max(f"{level}_weight").alias("weight"),
        ).withColumn("root", F.lit(0))
        if given is None:
            wanted = F.expr(f"sum(tokens) over (partition by root) * {share[0]}L div {share[1]}L")
            nodes = nodes.withColumn("given", F.least(wanted, F.sum("capacity").over(Window.partitionBy("root"))))
        else:
            nodes = nodes.join(given, path[:-1])
        shared = _shared_out(nodes, ["root", *path[:-1]], level)
        given = shared.select(*path, F.col("budget").alias("given"))
    return leaves.join(given.withColumnRenamed("given", "budget"), list(LEVELS))


def _order(seed: int) -> Column:
    """Where a document stands in an epoch of its leaf: a hash of id, seed and epoch."""
    return F.md5(F.concat_ws("|", F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(seed), F.col("epochs")))


def copies(docs: DataFrame, id_col: str, n_tokens: Column, domain: Column, weights: dict[str, Column],
           share: tuple[int, int], max_epochs: int, seed: int = 0, lang_col: str = "lang",
           source_col: str = "source", carry: Sequence[str] | None = None) -> DataFrame:
    """The columns ``carry`` of ``docs`` in ``row``, and ``id, domain, lang, source,
    n_tokens, budget, copies``.

    ``weights`` holds a whole number for each of ``domain``, ``lang``, ``source``, as
    expressions over those columns; a leaf with one below 1 gets nothing.  A leaf's
    budget is met by whole epochs of its documents and by the first documents of
    one more, in the order of a seeded hash, whose tokens fit.  Null domains,
    languages and sources are empty names; null counts are 0; ids may repeat, and
    documents alike in id and tokens come together or not at all.  Only the rows' own columns
    and one hash are compared, so the result does not depend on their layout.  An
    empty table gives no rows.
    """
    names = {"domain": domain, "lang": F.col(lang_col), "source": F.col(source_col)}
    kept = [F.col(c) for c in (docs.columns if carry is None else carry)]
    whole = docs.select(
        F.struct(*kept, F.lit(None).cast("boolean").alias("-")).alias("row"), F.col(id_col).alias("id"),
        F.coalesce(n_tokens.cast("long"), F.lit(0).cast("long")).alias("n_tokens"),
        *[F.coalesce(v.cast("string"), F.lit("")).alias(k) for k, v in names.items()],
    )
    whole = whole.withColumn("leaf", F.struct(*LEVELS))
    rows = settled(whole.drop("row"))
    leaves = rows.groupBy("leaf", *LEVELS).agg(
        F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("n_docs")
    ).withColumns({f"{k}_weight": w.cast("long") for k, w in weights.items()})
    leaves = settled(leaves)
    total = leaves.agg(F.coalesce(F.sum("n_docs"), F.lit(0))).first()[0]
    weighted = F.lit(True)
    for k in weights:
        weighted = weighted & (F.col(f"{k}_weight") > 0)
    budget = budgets(leaves.where(weighted), share, max_epochs).select("leaf", "budget")
    plan = leaves.select("leaf", "tokens", "n_docs").join(budget, "leaf", "left")
    plan = plan.withColumn("budget", F.coalesce("budget", F.lit(0).cast("long")))
    some = F.col("tokens") > 0
    plan = settled(
        plan.withColumns({
            "epochs": F.when(some, F.expr("budget div tokens")).otherwise(F.lit(0).cast("long")),
            "rest": F.when(some, F.col("budget") % F.col("tokens")).otherwise(F.lit(0).cast("long")),
        }).select("leaf", "n_docs", "budget", "epochs", "rest")
    )
    narrow = rows.select("leaf", "id", "n_tokens")
    ends = settled(_ends(attach(narrow, plan, "leaf", "n_docs", total), seed))
    plan = plan.join(ends, "leaf", "left")
    plan = settled(plan.join(_last(attach(narrow, plan, "leaf", "n_docs", total), seed), "leaf", "left"))
    # Everything about a leaf is one row, whose number is checked before it is sent to all tasks.
    if plan.count() <= SENT_LEAVES:
        placed = whole.join(F.broadcast(plan), "leaf")
    else:
        placed = attach(whole, plan, "leaf", "n_docs", total)
    place = F.struct(_order(seed).alias("at"), "n_tokens")
    stretch = F.substring(_order(seed), 1, STRETCH_DIGITS)
    # Where whole epochs meet the budget there is no more, not even of documents without tokens.
    more = (F.col("rest") > 0) & ((stretch < F.col("end")) | ((stretch == F.col("end")) & (place <= F.col("last"))))
    return placed.select(
        "row", "id", *LEVELS, "n_tokens", "budget",
        (F.col("epochs") + F.coalesce(more, F.lit(False)).cast("long")).alias("copies"),
    )


def _last(rows: DataFrame, seed: int) -> DataFrame:
    """Of each leaf, the place of the last document of its last epoch within the stretch where it ends."""
    at_end = rows.withColumn("at", _order(seed)).where(F.substring("at", 1, STRETCH_DIGITS) == F.col("end"))
    # Up to this place and with all documents at it.
    so_far = Window.partitionBy("leaf").orderBy("at", "n_tokens")
    fitting = at_end.withColumn("upto", F.col("before") + F.sum("n_tokens").over(so_far)).where("upto <= rest")
    return fitting.groupBy("leaf").agg(F.max(F.struct("at", "n_tokens")).alias("last"))


def _ends(rows: DataFrame, seed: int) -> DataFrame:
    """Of each leaf, the stretch in which the last, partial epoch ends, and the tokens before it."""
    sums = rows.groupBy("leaf", "rest", F.substring(_order(seed), 1, STRETCH_DIGITS).alias("stretch")).agg(
        F.sum("n_tokens").alias("n")
    )
    until = Window.partitionBy("leaf").orderBy("stretch").rowsBetween(Window.unboundedPreceding, 0)
    sums = sums.withColumn("upto", F.sum("n").over(until))
    over = sums.where("upto > rest").groupBy("leaf").agg(F.min(F.struct("stretch", "upto", "n")).alias("s"))
    return over.select("leaf", F.col("s.stretch").alias("end"), (F.col("s.upto") - F.col("s.n")).alias("before"))


def mixed(chosen: DataFrame, columns: list[str]) -> DataFrame:
    """The documents themselves, each as often as it was chosen."""
    repeated = chosen.where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return repeated.select(*[F.col("row").getField(c).alias(c) for c in columns])
