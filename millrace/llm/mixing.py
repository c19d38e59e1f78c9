"""Mixing sources to target weights.

A budget of tokens flows down the tree domain - language - source. At each node
it is split among the children by their weights; a child that cannot use its part
(its documents, `epochs` times over, hold fewer tokens) gives the rest to its
siblings, and only what the siblings cannot use either goes back to the
ancestors: a node is never given more than its whole subtree can use.

Each leaf repeats its documents whole as long as the budget lasts and takes the
last epoch as a prefix of a seeded permutation, down to the token.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.components import _stored
from millrace.llm.frames import PREFIX

LEVELS = ("domain", "lang", "source")
EPOCHS = 3
SEED = 17
# Digits of the permutation's hash that name a part of a leaf: 4,096 parts.
PART_DIGITS = 3
WHOLE = "decimal(38,0)"


def count_tokens(text: str = "text") -> Column:
    """Words of a text; NULL has none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def _weight(column: str, weights: Mapping[str, int]) -> Column:
    """Whole-number weight of a name; 1 where none is given."""
    found = F.lit(1)
    for name, weight in weights.items():
        found = F.when(F.col(column) == name, F.lit(int(weight))).otherwise(found)
    return found.cast(WHOLE)


def _split(nodes: DataFrame, parent: list[str], name: str) -> DataFrame:
    """Adds `budget` to siblings with `weight`, `cap` and the parent's `given`.

    Children are taken by rising cap per weight: while a child's cap is no more
    than its share of what is left, it gets its cap. The others share the rest by
    weight, in whole tokens, by differences of rounded running shares.
    """
    by_need = Window.partitionBy(*parent).orderBy(F.col("cap").cast("double") / F.col("weight").cast("double"), name)
    earlier, later = by_need.rowsBetween(Window.unboundedPreceding, -1), by_need.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy(*parent)
    ranked = nodes.withColumns(
        {
            "_used": F.coalesce(F.sum("cap").over(earlier), F.lit(0)).cast(WHOLE),
            "_weights": F.sum("weight").over(later).cast(WHOLE),
        }
    )
    full = F.col("cap") * F.col("_weights") <= (F.col("given") - F.col("_used")) * F.col("weight")
    flagged = ranked.withColumn("_full", full).withColumn("_open", F.when(F.col("_full"), F.lit(0)).otherwise(F.col("weight")).cast(WHOLE))
    upto = Window.partitionBy(*parent).orderBy(name).rowsBetween(Window.unboundedPreceding, 0)
    summed = flagged.withColumns(
        {
            "_rest": (F.col("given") - F.coalesce(F.sum(F.when(F.col("_full"), F.col("cap"))).over(whole), F.lit(0))).cast(WHOLE),
            "_all": F.sum("_open").over(whole).cast(WHOLE),
            "_upto": F.sum("_open").over(upto).cast(WHOLE),
        }
    )
    share = F.expr("(_rest * _upto) div _all - (_rest * (_upto - _open)) div _all")
    return summed.withColumn("budget", F.when(F.col("_full"), F.col("cap")).otherwise(share).cast("bigint")).drop(
        "_used", "_weights", "_full", "_open", "_rest", "_all", "_upto"
    )


def budgets(leaves: DataFrame, weights: Mapping[str, Mapping[str, int]], budget: int | None = None, epochs: int = EPOCHS) -> DataFrame:
    """`leaves` (domain, lang, source, tokens) with `budget`. The whole budget is by
    default all tokens there are; more than all can use is cut to that."""
    cap = F.sum(F.col("tokens") * epochs)
    total = leaves.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
    asked = min(total if budget is None else budget, total * epochs)
    given = F.lit(asked).cast(WHOLE)
    parents: DataFrame | None = None
    for depth, name in enumerate(LEVELS):
        above, path = list(LEVELS[:depth]), list(LEVELS[: depth + 1])
        nodes = leaves.groupBy(*path).agg(cap.cast(WHOLE).alias("cap")).withColumn("weight", _weight(name, weights.get(name, {})))
        if parents is None:
            nodes = nodes.withColumn("given", given)
        else:
            nodes = nodes.join(parents.select(*above, F.col("budget").cast(WHOLE).alias("given")), above)
        parents = _split(nodes, above, name).select(*path, "budget")
    return leaves.join(parents, list(LEVELS))


def _place(seed: int, epoch: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))


def select_documents(
    docs: DataFrame,
    domain: Column,
    weights: Mapping[str, Mapping[str, int]],
    budget: int | None = None,
    epochs: int = EPOCHS,
    seed: int = SEED,
) -> DataFrame:
    """(doc_id, domain, lang, source, tokens, epoch, taken): a row for each time a
    document is used, with how many of its tokens, counted from its start.

    `docs` needs `doc_id`, `text`, `lang` and `source`. NULL names are the name
    ''. Documents without words are part of every whole epoch of their leaf, with
    nothing taken, and are never in a prefix. Rows that share a `doc_id` are
    selected one by one. Weights are whole numbers, 1 where none is given; weight
    0 is not allowed, leave such rows out. An empty table gives no rows.
    """
    rows = _use(docs, ["doc_id"], domain, weights, budget, epochs, seed)
    return rows.select("doc_id", *LEVELS, "tokens", "epoch", "taken")


def _use(
    docs: DataFrame, keep: list[str], domain: Column, weights: Mapping[str, Mapping[str, int]], budget: int | None, epochs: int, seed: int
) -> DataFrame:
    """The kept columns of a row, those of the leaf, `tokens`, `epoch` and `taken`, for
    each time it is used. `keep` holds `doc_id`; columns that clash are to be renamed."""
    name = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    thin = _stored(
        docs.select(
            *[F.col(f"`{c}`") for c in keep],
            name(domain).alias("domain"), name(F.col("lang")).alias("lang"), name(F.col("source")).alias("source"),
            count_tokens().alias("tokens"),
        ),
        "tokens",
    )
    leaves = thin.groupBy(*LEVELS).agg(F.sum("tokens").alias("tokens"))
    plan = budgets(leaves, weights, budget, epochs).select(
        *LEVELS,
        F.when(F.col("tokens") > 0, F.expr("budget div tokens")).otherwise(0).alias("whole"),
        F.when(F.col("tokens") > 0, F.col("budget") % F.col("tokens")).otherwise(0).alias("rest"),
    )
    plan = _stored(plan, "budgets")
    rows = thin.join(plan, list(LEVELS))
    repeated = (
        rows.where("whole > 0")
        .withColumn("epoch", F.explode(F.sequence(F.lit(0), (F.col("whole") - 1).cast("int"))))
        .withColumn("taken", F.col("tokens"))
    )
    # The prefix of the last epoch: totals of parts of a leaf, then sums within a part.
    last = rows.where("rest > 0 and tokens > 0").withColumn("_place", _place(seed, F.col("whole")))
    last = last.withColumn("_part", F.substring("_place", 1, PART_DIGITS))
    parts = last.groupBy(*LEVELS, "_part").agg(F.sum("tokens").alias("_tokens"))
    before = Window.partitionBy(*LEVELS).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(*LEVELS, "_part", F.coalesce(F.sum("_tokens").over(before), F.lit(0)).alias("_offset"))
    within = Window.partitionBy(*LEVELS, "_part").orderBy("_place", "tokens").rowsBetween(Window.unboundedPreceding, 0)
    prefix = (
        last.withColumn("_upto", F.sum("tokens").over(within))
        .join(offsets, [*LEVELS, "_part"])
        .withColumn("_left", F.col("rest") - F.col("_offset") - F.col("_upto") + F.col("tokens"))
        .where("_left > 0")
        .withColumns({"epoch": F.col("whole").cast("int"), "taken": F.least("tokens", "_left")})
    )
    columns = [*[F.col(f"`{c}`") for c in keep], *LEVELS, "tokens", "epoch", "taken"]
    return repeated.select(*columns).unionByName(prefix.select(*columns))


# Between a word and the white space after it.
_WORD_END = r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])"


def first_words(text: str, n: str) -> Column:
    """A text up to the end of its first `n` words, white space unchanged."""
    return F.array_join(F.slice(F.split(F.col(text), _WORD_END), F.lit(1), F.col(n).cast("int")), "")


def mix(
    docs: DataFrame,
    domain: Column,
    weights: Mapping[str, Mapping[str, int]],
    budget: int | None = None,
    epochs: int = EPOCHS,
    seed: int = SEED,
) -> DataFrame:
    """The rows of `docs`, once for each time the mix uses them, with `epoch`, `taken`
    and `cut`: a text in which a leaf's prefix ends is cut to its first `taken` words
    (`cut` is true), all others are whole. Each row is used by itself, also without
    `doc_id` or where rows share one. Columns of these names are replaced."""
    kept = [c for c in docs.columns if c.lower() not in ("epoch", "taken", "cut")]
    own = {c: f"{PREFIX}{c}" for c in kept if c not in ("doc_id", "text")}
    carried = docs.select(*kept).withColumns({new: F.col(f"`{c}`") for c, new in own.items()})
    used = _use(carried, ["doc_id", "text", *own.values()], domain, weights, budget, epochs, seed)
    cut = F.col("taken") < F.col("tokens")
    text = F.when(cut, first_words("text", "taken")).otherwise(F.col("text"))
    return used.select(
        *[text.alias(c) if c == "text" else F.col(own.get(c, c)).alias(c) for c in kept], cut.alias("cut"), "epoch", "taken"
    )
