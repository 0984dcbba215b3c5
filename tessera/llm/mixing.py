"""Mixing sources to target weights by pivotal dependent rounding.

Every document starts with the fractional copy count ``target / size`` of its
source.  The whole part is taken outright; the fraction is rounded by pivoting:
two documents at a time pass words to one another at random, so that the sum
of their words and each one's expectation stay as they are, until one of them
is taken or left for good.  The one that is still fractional meets the next.
Groups of documents leave one residual each; residuals are combined level by
level in a reduction tree, and one residual per source is rounded at last.  So
a source misses its target by less than one document.  A fold takes the largest
documents first, so that the one left over, and with it the miss, is a small
one as a rule.  All native expressions: a group's fold is SQL's ``aggregate``
over its array.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.llm.common import materialize, small_side

WORD = "[^\\x20\\x09-\\x0D]+"
#: The most copies of one document.
MAX_COPIES = 3
#: Repeats of a row that one row of the last step spreads out.
SPREAD = 65_536


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (1, 2, 3),
                   max_copies: int = MAX_COPIES) -> DataFrame:
    """``source, n_docs, source_size, target`` of a table of ``source, size``,
    or ``source, size, n`` with rows that stand for ``n`` documents.
    ``n_docs`` counts the rows of the table.

    Sources in code-point order, null last, weigh ``weights``, repeating.
    Targets share the sum of all sizes by weight, none above ``max_copies``
    times its source's size; what is above is shared again by weight.  The
    table has a row per source, which is all that passes through its window.
    """
    words = F.col("size") * F.col("n") if "n" in sizes.columns else F.col("size")
    per = materialize(sizes.groupBy("source").agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum(words).alias("source_size")), "mix_sources")
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(rank, F.lit(len(weights))) + 1)
    per = materialize(per.withColumn("w", weight).withColumn("cap", F.col("source_size") * float(max_copies)),
                      "mix_weights")
    # water level: sources whose share at this level is above their cap stay at the cap
    level, capped = 0.0, -1
    while True:
        at_cap = F.col("w") * level >= F.col("cap") if capped >= 0 else F.lit(False)
        free_w, left, n = per.agg(
            F.sum(F.when(~at_cap, F.col("w"))), F.sum("source_size") - F.sum(F.when(at_cap, F.col("cap")).otherwise(0.0)),
            F.count(F.when(at_cap, 1))).first()
        if n == capped or not free_w or not left:
            break
        level, capped = left / free_w, n
    return per.select("source", "n_docs", "source_size",
                      F.least(F.col("cap"), F.col("w") * level).alias("target"))


def pivot_group(items: str, seed: int) -> str:
    """SQL that folds an array of structs of ``id, size, mass, n`` (all masses
    strictly between 0 and the size), in its order, to ``struct<cur, done>``.

    Mass moves from a to b with probability d2/(d1+d2) and from b to a
    otherwise, where d1 and d2 are the most that can move either way.
    """
    u = f"(pmod(xxhash64(s.cur.id, s.cur.mass, x.id, x.mass, {seed}), 1048576) + 0.5D) / 1048576D"
    d1, d2 = "least(s.cur.mass, x.size - x.mass)", "least(x.mass, s.cur.size - s.cur.mass)"
    item = "named_struct('id', {0}.id, 'size', {0}.size, 'mass', {1}, 'n', {0}.n)"
    taken = "named_struct('id', {0}.id, 'size', {0}.size, 'n', {0}.n, 'bit', {1}L)"
    a_out, b_out = "s.cur.mass <= x.size - x.mass", "x.mass <= s.cur.size - s.cur.mass"

    def step(cur: str, done: str) -> str:
        return f"named_struct('cur', {cur}, 'done', array_append(s.done, {done}))"

    to_b = (f"if({a_out}, {step(item.format('x', 'x.mass + s.cur.mass'), taken.format('s.cur', 0))}, "
            f"{step(item.format('s.cur', 's.cur.mass - (x.size - x.mass)'), taken.format('x', 1))})")
    to_a = (f"if({b_out}, {step(item.format('s.cur', 's.cur.mass + x.mass'), taken.format('x', 0))}, "
            f"{step(item.format('x', 'x.mass - (s.cur.size - s.cur.mass)'), taken.format('s.cur', 1))})")
    none = "cast(array() as array<struct<id:bigint,size:bigint,n:bigint,bit:bigint>>)"
    first = item.format(f"{items}[0]", f"{items}[0].mass")
    return (f"aggregate(slice({items}, 2, size({items})), named_struct('cur', {first}, 'done', {none}), "
            f"(s, x) -> if({u} < {d2} / ({d1} + {d2}), {to_b}, {to_a}))")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[float, ...] = (1, 2, 3), max_copies: int = MAX_COPIES,
        fan_in: int = 64, seed: int = 7) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, ``source``, ``size`` (words),
    ``source_size``, ``target`` (both the source's), ``copies`` and ``taken``
    (``copies * size``).

    Null texts have size 0; a null source is a source of its own, weighed
    last.  Documents without words take no part in the rounding: they get the
    whole part of the copy count.  Rows repeated under one id, source and size
    are taken alike, as one document of their summed size; they are told apart
    only in the result, at most ``SPREAD`` by one row.  Ids are integers; a null
    id is an id like any other.  An empty table gives an empty result.
    Randomness is a hash of ids and ``seed``, and every fold runs from the
    largest document down, then by id, so reruns agree.

    A hot source is dealt out over groups of about ``fan_in`` documents; each
    level of the tree divides the rows left by about ``fan_in``.  About as many
    documents of every source are held back for its last group, where what the
    tree leaves over, often large, is spread over them.
    """
    sized = materialize(
        docs.select(F.col(id_col).cast("long").alias("id"), F.col(source_col).alias("source"),
                    word_count(F.col(text_col)).alias("size"))
        .groupBy("source", "id", "size").agg(F.count(F.lit(1)).alias("n")), "mix_sizes")
    targets = materialize(source_targets(sized.select("source", "size", "n"), weights, max_copies), "mix_targets")
    t = small_side(targets.select(F.col("source").alias("src"), "n_docs", "source_size", "target"))
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rows = (sized.join(t, F.col("source").eqNullSafe(F.col("src")), "left")
            .withColumn("whole", F.floor(ratio))
            .withColumn("mass", (ratio - F.col("whole")) * F.col("size") * F.col("n"))
            .withColumn("words", F.col("size") * F.col("n"))
            .select("source", "id", "size", "n", "words", "whole", "mass", "n_docs", "source_size", "target"))
    settled = (F.col("mass") <= 0) | (F.col("mass") >= F.col("words"))
    rows = materialize(rows, "mix_rows")

    most = rows.where(~settled).groupBy("source").agg(F.count(F.lit(1)).alias("k")).agg(F.max("k")).first()[0] or 0
    levels = max(1, math.ceil(math.log(max(most, 2), fan_in)))
    open_rows = rows.where(~settled).select("source", "id", F.col("words").alias("size"), "mass", "n",
                                            F.col("n_docs").alias("k"))
    for_last = F.pmod(F.xxhash64("id", "size", F.lit(seed + 211)), F.col("k")) < fan_in
    held, open_rows = open_rows.where(for_last), open_rows.where(~for_last)
    decided: list[DataFrame] = []
    for level in range(levels + 1):
        last = level == levels
        if last:
            open_rows = open_rows.unionByName(held)
        buckets = F.lit(1) if last else F.greatest(F.lit(1), F.ceil(F.col("k") / fan_in)).cast("long")
        dealt = (open_rows.withColumn("b", F.pmod(F.xxhash64("id", "size", F.lit(seed + level)), buckets))
                 .groupBy("source", "b")
                 .agg(F.array_sort(F.collect_list(F.struct((-F.col("size")).alias("o"), "id", "size", "mass", "n"))).alias("g"),
                      F.max("k").alias("k")))
        folded = materialize(dealt.withColumn("f", F.expr(pivot_group("g", seed + level)))
                             .select("source", "k", "f"), f"mix_level{level}")
        decided.append(folded.select("source", F.explode("f.done").alias("d")).select("source", "d.*"))
        open_rows = folded.select("source", "f.cur.*", F.ceil(F.col("k") / fan_in).alias("k"))
    # one residual per source is left: a single draw
    u = (F.pmod(F.xxhash64("id", "mass", F.lit(seed + 101)), F.lit(1048576)) + 0.5) / 1048576.0
    decided.append(open_rows.select("source", "id", "size", "n",
                                    F.when(u * F.col("size") < F.col("mass"), 1).otherwise(0).cast("long").alias("bit")))
    bits = decided[0]
    for d in decided[1:]:
        bits = bits.unionByName(d)
    bits = bits.select(F.col("source").alias("src"), F.col("size").alias("s"), "id", "n", "bit",
                       ).withColumn("one", (F.col("s") / F.col("n")).cast("long")).drop("s")

    t = small_side(targets.select(F.col("source").alias("src"), "source_size", "target"))
    done = (bits.withColumnRenamed("src", "source").join(t, F.col("source").eqNullSafe(F.col("src")), "left")
            .select("id", "source", F.col("one").alias("size"), "n", "source_size", "target",
                    (F.floor(F.col("target") / F.col("source_size")) + F.col("bit")).alias("copies")))
    rest = (rows.where(settled).select("id", "source", "size", "n", "source_size", "target",
                                       (F.col("whole") + F.when(F.col("mass") > 0, 1).otherwise(0)).alias("copies")))
    return (done.unionByName(rest)
            .withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {SPREAD}"))))
            .withColumn("i", F.explode(F.expr(f"array_repeat(0, cast(least({SPREAD}, n - part * {SPREAD}) as int))")))
            .select(F.col("id").alias(id_col), "source", "size", "source_size", "target",
                    F.col("copies").cast("long").alias("copies"),
                    (F.col("copies") * F.col("size")).cast("long").alias("taken")))


def mix_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  source_col: str = "source", **kw) -> DataFrame:
    """The mixed corpus: the rows of ``docs``, each as often as the mix takes it."""
    picks = small_side(materialize(
        mix(docs, id_col, text_col, source_col, **kw).where("copies > 0")
        .select(F.col(id_col).alias("id"), F.col("source").alias("src"), F.col("size").alias("words"), "copies")
        .distinct(), "mix_picks"))
    on = (docs[id_col].cast("long").eqNullSafe(picks["id"]) & docs[source_col].eqNullSafe(picks["src"])
          & (word_count(docs[text_col]) == picks["words"]))
    number = "copy"
    while number in docs.columns:
        number += "_"
    copies = F.explode(F.array_repeat(F.lit(0), picks["copies"].cast("int"))).alias(number)
    return docs.join(picks, on, "inner").select(*[docs[c] for c in docs.columns], copies).drop(number)
