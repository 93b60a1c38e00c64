"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in a fixed shuffled order, repeated
up to ``epochs`` times. A document's virtual time is the number of tokens
its source has served by then divided by the source's weight; all queues are
merged by a global range sort on it and cut where the running total of
tokens reaches the budget. A source whose queue runs dry leaves its share to
the others by weight, which is exactly the water-filling of the targets.

Virtual time counts half of the document itself (the mean of its virtual
start and finish), so that the cut rounds each source to the nearest whole
document instead of always down.

Only DataFrame operations: one pass over the texts for the sizes, then
narrow rows. A hot source is spread by the range sorts, whose key goes on
with a hash of the document; running totals use one offset per range
partition. Per source there is one row (an aggregate), joined back as a
plain join (the planner broadcasts it only if its size is small).

Defined cases: null text has size 0 and takes nothing; a null source is a
source of its own, sorted last; rows that repeat a document are documents of
their own, taken in a fixed order; an empty table gives an empty result;
a budget above ``epochs`` times all tokens takes everything ``epochs``
times; documents of equal virtual time at the cut enter together. Only the
named columns are read, so other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medallion_ops.llm.common import col, partition_offsets, range_stage, running_total
from medallion_ops.session import materialize

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of words that are not separated by ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(sized: DataFrame, weights: Sequence[float], budget: float, epochs: int) -> tuple[DataFrame, float]:
    """Per source its size, weight and target; and the budget in tokens.

    ``sized`` has ``source`` and ``size``. Sources in code-point order (null
    last) take the weights in turn. With r = cap / weight, a source is at its
    cap exactly if serving every source up to virtual time r fits the
    budget; the others stop at the common virtual time that uses the rest.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.lit(1).cast("bigint").alias("one"))
    by_name = [F.col("source").asc_nulls_last()]
    per = running_total(per, by_name, {"place": "one", "upto": "source_size"}, "mix_sources")
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    per = per.select("source", "source_size", "place", (F.col("upto") - F.col("source_size")).alias("before"),
                     F.element_at(cycle, ((F.col("place") - 1) % len(weights) + 1).cast("int")).alias("weight"),
                     (F.col("source_size") * float(epochs)).alias("cap"))
    per = materialize(per.withColumn("r", F.col("cap") / F.col("weight")), "mix_weights")
    all_ = per.agg(F.sum("source_size").alias("s"), F.sum("weight").alias("w")).collect()[0]
    total, weight = float(all_["s"] or 0), float(all_["w"] or 0)
    tokens = budget * total

    filled = running_total(per, [F.col("r").asc(), F.col("place").asc()], {"caps": "cap", "weights": "weight"},
                           "mix_filled")
    fits = F.col("caps") + F.col("r") * (F.lit(weight) - F.col("weights")) <= F.lit(tokens)
    filled = materialize(filled.withColumn("capped", fits), "mix_capped")
    rest = filled.agg(F.sum(F.when(F.col("capped"), F.col("cap")).otherwise(0.0)).alias("caps"),
                      F.sum(F.when(~F.col("capped"), F.col("weight")).otherwise(0.0)).alias("w")).collect()[0]
    level = (tokens - (rest["caps"] or 0.0)) / rest["w"] if rest["w"] else 0.0   # used by uncapped sources only
    target = F.when(F.col("capped"), F.col("cap")).otherwise(F.col("weight") * F.lit(level))
    return filled.select("source", "source_size", "place", "before", "weight", target.alias("target")), tokens


def cut_time(entries: DataFrame, tokens: float) -> float | None:
    """Virtual time of the last entry within ``tokens``: global range sort, then only the crossing partition."""
    order = [F.col(c).asc() for c in ("vtime", "place", "epoch", "shuffle", "doc_id", "size")]
    stage = range_stage(entries, order, "mix_queue")
    first = Window.orderBy("__pid")
    spans = partition_offsets(stage, "size").withColumn("__next", F.lead("__before").over(first))
    cross = (spans.where((F.col("__before") < tokens) & (F.col("__next").isNull() | (F.col("__next") >= tokens)))
             .orderBy("__pid").limit(1).collect())
    if not cross:
        return None
    pid, before = cross[0]["__pid"], cross[0]["__before"]
    rows = stage.where(F.col("__pid") == pid)
    run = F.sum("size").over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    inside = rows.withColumn("run", run + F.lit(before)).where(F.col("run") - F.col("size") / 2.0 <= tokens)
    here = inside.agg(F.max("vtime")).collect()[0][0]
    if here is None:   # the crossing document itself stays out: the cut is the end of the partition before
        here = stage.where(F.col("__pid") < pid).agg(F.max("vtime")).collect()[0][0]
    return here


def mix_to_weights(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), budget: float = 1.5, epochs: int = 2,
                   seed: str = "mix", id_col: str = "doc_id", text_col: str = "text",
                   source_col: str = "source", size: Column | None = None) -> DataFrame:
    """One row per document: how often the mix takes it.

    Columns: doc_id, source, size, source_size, weight, target (tokens its
    source should give), copies (0..epochs) and taken (size x copies).
    ``size`` may replace the word count by any non-negative integer column.
    """
    sized = docs.select(col(id_col).alias("doc_id"), col(source_col).cast("string").alias("source"),
                        (word_count(col(text_col)) if size is None else size.cast("bigint")).alias("size"))
    shuffle = F.md5(F.concat_ws(":", F.lit(seed), F.col("doc_id").cast("string")).cast("binary"))
    sized = materialize(sized.withColumn("shuffle", shuffle), "mix_sizes")
    targets, tokens = source_targets(sized, weights, budget, epochs)
    targets = materialize(targets, "mix_targets")

    s, t = sized.alias("s"), targets.alias("t")
    docs_at = s.join(t, F.col("s.source").eqNullSafe(F.col("t.source")), "inner").select(
        "s.doc_id", "s.source", "s.size", "s.shuffle", "t.source_size", "t.place", "t.before", "t.weight", "t.target")
    served = running_total(docs_at, [F.col(c).asc() for c in ("place", "shuffle", "doc_id", "size")],
                           {"served": "size"}, "mix_served")
    start = F.col("served") - F.col("before") - F.col("size") / 2.0   # in its source, to the middle of the document
    served = materialize(served.withColumn("middle", start), "mix_order")

    at = lambda e: (F.col("middle") + e * F.col("source_size").cast("double")) / F.col("weight")
    entries = (served.where("size > 0")
               .select("place", "shuffle", "doc_id", "size", "middle", "source_size", "weight",
                       F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))).alias("epoch"))
               .select(at(F.col("epoch")).alias("vtime"), "place", "epoch", "shuffle", "doc_id", "size"))
    cut = cut_time(entries, tokens)
    copies = F.lit(0)
    if cut is not None:
        for e in range(epochs):
            copies = copies + F.when(at(F.lit(e)) <= F.lit(cut), 1).otherwise(0)
    copies = F.when(F.col("size") > 0, copies).otherwise(0).cast("int")
    return served.withColumn("copies", copies).select(
        "doc_id", "source", "size", "source_size", "weight", "target", "copies",
        (F.col("size") * F.col("copies")).alias("taken"))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                    **params) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken, with the columns of ``docs``.

    Rows are matched by id, source and size, for which the mix counts copies
    alike; rows that repeat all three are told apart by their number among
    them. A document without words takes part in no share and is not emitted.
    """
    plan = mix_to_weights(docs, id_col=id_col, text_col=text_col, source_col=source_col, **params)
    plan = (plan.where("copies > 0").groupBy(_row_key(F.col("doc_id"), F.col("source"), F.col("size")).alias("__mix_key"))
            .agg(F.sum("copies").alias("__mix_all"), F.count(F.lit(1)).alias("__mix_rows")))
    key = _row_key(col(id_col), col(source_col), word_count(col(text_col)))
    both = docs.withColumn("__mix_key", key).join(plan, "__mix_key", "inner")
    # equal rows of one document share its copies: the first ones get one more
    nth = F.row_number().over(Window.partitionBy("__mix_key").orderBy(col(text_col)))
    times = F.floor(F.col("__mix_all") / F.col("__mix_rows")) + F.when(nth <= F.col("__mix_all") % F.col("__mix_rows"), 1).otherwise(0)
    both = both.withColumn("__mix_times", times.cast("int")).where("__mix_times > 0")
    return both.withColumn("__mix_copy", F.explode(F.sequence(F.lit(1), F.col("__mix_times")))).select(
        *[col(c) for c in docs.columns])


def _row_key(doc_id: Column, source: Column, size: Column) -> Column:
    """One non-null key for id, source and size, so that join and window share a partitioning."""
    parts = [F.coalesce(c.cast("string"), F.lit("\x00null")) for c in (doc_id, source, size)]
    return F.md5(F.concat_ws("\x01", *parts).cast("binary"))
