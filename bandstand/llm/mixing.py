"""Mixing sources to target sizes by pivotal rounding in a reduction tree. DataFrame functions only.

Every document of a source should be taken target / size times; the whole part is taken for sure, the
fraction is a probability. Two open fractions exchange mass (probability times size) in a random direction
until one of them is 0 or 1, so that the expectation of each stays what it was and the words of the source stay
at its target. Documents are dealt into small groups by their rank; each group folds its fractions into one,
and the residuals of the groups are folded level by level until one fraction is left per source. That one is
rounded to the nearer number; what it leaves too much or too little is made up by one document of that size.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from bandstand.functions.ordering import with_row_number, with_running_totals
from bandstand.runtime import Scratch

# The contract's words: a fixed value.
WORD = r"[^\x20\x09-\x0D]+"
_ITEM = "struct<rid:bigint,doc_id:bigint,th:bigint,size:bigint,p:double>"
_CLOSE = 1e-9


@dataclass(frozen=True)
class Mix:
    """Weights, repeating over the sources in code point order; most copies; share of all words; group size; seed."""

    weights: tuple[int, ...] = (1, 2, 3)
    most: int = 3
    share: float = 1.0
    group: int = 128
    seed: int = 11


def _sized(docs: DataFrame, id_column: str, text_column: str, source_column: str) -> DataFrame:
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    return docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.col(source_column).cast("string").alias("source"),
        F.xxhash64(text).alias("th"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
    )


def source_targets(sized: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """``source, source_size, target``: shares by weight, none above ``most`` times its source's size.

    ``sized`` has ``source, size``. Sources are ordered by code point, null last. What a source cannot take is
    shared again by weight. The sources that stop at their limit are a prefix of the order by limit / weight,
    found with running totals.
    """
    stats = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = with_row_number(stats, [F.col("source").asc_nulls_last()], "rank")
    weights = F.array(*[F.lit(float(w)) for w in mix.weights])
    ranked = ranked.withColumns(
        {
            "weight": F.element_at(weights, (F.pmod(F.col("rank") - 1, F.lit(len(mix.weights))) + 1).cast("int")),
            "limit": F.col("source_size") * float(mix.most),
        }
    )
    order = [(F.col("limit") / F.col("weight")), F.col("rank")]
    running = with_running_totals(ranked, order, {"limits": F.col("limit"), "weights": F.col("weight")})
    total, all_weights = ranked.agg(F.sum("source_size") * mix.share, F.sum("weight")).first()
    total, all_weights = total or 0.0, all_weights or 1.0
    left = F.lit(total) - (F.col("limits") - F.col("limit"))
    left_weight = F.lit(all_weights) - (F.col("weights") - F.col("weight"))
    marked = running.withColumn("stops", F.col("limit") * left_weight <= left * F.col("weight"))
    stopped, open_weights = marked.agg(F.sum(F.when(F.col("stops"), F.col("limit"))), F.sum(F.when(~F.col("stops"), F.col("weight")))).first()
    each = (total - (stopped or 0.0)) / open_weights if open_weights else 0.0
    target = F.when(F.col("stops"), F.col("limit")).otherwise(F.col("weight") * each)
    return marked.select("source", "source_size", target.alias("target"))


def _uniform(seed: int, *ids: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), *ids), F.lit(1 << 53)) / float(1 << 53)


def _is_whole(p: Column) -> Column:
    return (p < _CLOSE) | (p > 1 - _CLOSE)


def _with_p(item: Column, p: Column) -> Column:
    return item.withField("p", p)


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _fold(items: Column, seed: int) -> Column:
    """``open`` (the item that stays fractional, or null) and ``done`` of a group of items."""

    def pair(acc: Column, x: Column) -> Column:
        c = acc["open"]
        up = F.least(c["size"] * (1 - c["p"]), x["size"] * x["p"])
        down = F.least(c["size"] * c["p"], x["size"] * (1 - x["p"]))
        goes_up = _uniform(seed, c["rid"], x["rid"]) * (up + down) < down
        moved = _let(
            F.when(goes_up, up).otherwise(-down),
            lambda m: F.struct(
                _with_p(c, c["p"] + m / c["size"]).alias("c"), _with_p(x, x["p"] - m / x["size"]).alias("x")
            ),
        )

        def settle(both: Column) -> Column:
            whole_c, whole_x = _is_whole(both["c"]["p"]), _is_whole(both["x"]["p"])
            done = F.filter(F.array(both["c"], both["x"]), lambda i: _is_whole(i["p"]))
            stays = F.when(~whole_c, both["c"]).when(~whole_x, both["x"])
            return F.struct(stays.alias("open"), F.concat(acc["done"], done).alias("done"))

        return F.when(c.isNull(), F.struct(x.alias("open"), acc["done"].alias("done"))).otherwise(_let(moved, settle))

    empty = F.struct(F.lit(None).cast(_ITEM).alias("open"), F.array().cast(f"array<{_ITEM}>").alias("done"))
    return F.aggregate(items, empty, pair)


def _rounded(scratch: Scratch, rows: DataFrame, mix: Mix) -> DataFrame:
    """``source`` and the items with ``p`` 0 or 1; ``rows``: source, rid (dense rank), doc_id, th, size, p.

    Ranks are dealt in turn to the groups of a source, so every group has large documents first and small ones
    behind them, and what a group leaves open is small.
    """
    counts = scratch.write(rows.groupBy(F.col("source").alias("_source")).agg(F.count("*").alias("n")))
    most = counts.agg(F.max("n")).first()[0] or 1
    item = F.struct("rid", "doc_id", "th", "size", "p").alias("item")
    open_rows = rows.join(counts, F.col("source").eqNullSafe(F.col("_source"))).select("source", "n", F.col("rid").alias("turn"), item)
    done: list[DataFrame] = []
    reach = 1
    while True:
        reach *= mix.group
        bucket = F.pmod(F.col("turn"), F.ceil(F.col("n") / reach)).alias("bucket")
        groups = open_rows.groupBy("source", "n", bucket).agg(F.sort_array(F.collect_list("item")).alias("items"))
        folded = scratch.write(groups.select("source", "n", "bucket", _fold(F.col("items"), mix.seed).alias("f")).select("source", "n", "bucket", "f.open", "f.done"))
        done.append(folded.select("source", F.explode("done").alias("item")))
        left = folded.where("open is not null")
        if reach >= most:
            # One fraction per source: the nearer whole number keeps the source nearest to its target.
            nearest = _with_p(F.col("open"), F.round(F.col("open.p")))
            done.append(left.select("source", nearest.alias("item")))
            break
        open_rows = left.select("source", "n", F.col("bucket").alias("turn"), F.col("open").alias("item"))
    out = done[0]
    for more in done[1:]:
        out = out.union(more)
    return out.select("source", "item.*")


def _made_up(scratch: Scratch, sure: DataFrame, drawn: DataFrame, targets: DataFrame) -> DataFrame:
    """``drawn`` with one document per source taken once more or less, if that brings the source nearer."""
    words = F.sum(F.col("size") * F.col("copies")).alias("words")
    taken = sure.select("source", "size", "copies").union(drawn.select("source", "size", "copies")).groupBy("source").agg(words)
    of = targets.select(F.col("source").alias("_source"), "target")
    errors = taken.join(of, F.col("source").eqNullSafe(F.col("_source"))).select("_source", (F.col("words") - F.col("target")).alias("error"))
    errors = scratch.write(errors)
    distance = F.abs(F.col("size") - F.abs("error"))
    fits = (F.col("up") == F.when(F.col("error") > 0, 1).otherwise(0)) & (distance < F.abs("error"))
    asked = drawn.join(errors, F.col("source").eqNullSafe(F.col("_source"))).where(fits)
    best = asked.groupBy("_source").agg(F.min(F.struct(distance.alias("distance"), "rid")).alias("best"))
    flips = scratch.write(best.select(F.col("best.rid").alias("_rid")))
    flipped = F.when(F.col("_rid").isNull(), F.col("copies")).otherwise(F.col("whole") + 1 - F.col("up"))
    return drawn.join(flips, drawn["rid"] == F.col("_rid"), "left").withColumn("copies", flipped)


def mix_plan(docs: DataFrame, id_column: str, text_column: str, source_column: str, mix: Mix = Mix()) -> DataFrame:
    """Per row ``doc_id, source, th, size, source_size, target, copies, taken``.

    ``size`` is the number of words (null text: 0), ``th`` a hash of the text, ``copies`` how often the mix takes
    the document, at most ``mix.most``, and ``taken`` its words, repeats counted. A document without words is not
    taken. A null source is a source, ordered last; a null id stays null. Rows that repeat an id are documents of
    their own. The result depends on the rows only, not on their order. An empty table gives an empty result.
    """
    scratch = Scratch(docs.sparkSession, "mixing")
    sized = scratch.write(_sized(docs, id_column, text_column, source_column))
    targets = scratch.write(source_targets(sized, mix))
    of = targets.withColumnRenamed("source", "_source")
    factor = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    met = sized.join(of, F.col("source").eqNullSafe(F.col("_source"))).withColumn("factor", F.when(F.col("size") > 0, factor).otherwise(0.0))
    near = F.round("factor")
    whole = F.when(F.abs(F.col("factor") - near) < _CLOSE, near).otherwise(F.floor("factor")).cast("long")
    met = met.withColumn("whole", whole).withColumn("p", F.greatest(F.lit(0.0), F.col("factor") - F.col("whole")))
    sure = met.where(F.col("p") < _CLOSE).select("doc_id", "source", "th", "size", F.col("whole").alias("copies"))
    # Large documents first, so that the small ones that follow settle what they leave open.
    order = [F.col("source"), F.col("size").desc(), F.xxhash64(F.lit(mix.seed), "doc_id", "th"), F.col("doc_id"), F.col("th")]
    open_rows = met.where(F.col("p") >= _CLOSE).select("doc_id", "source", "th", "size", "p")
    ranked = scratch.write(with_row_number(open_rows, order, "rid"))
    rounded = scratch.write(_rounded(scratch, ranked, mix).withColumn("up", F.round("p").cast("long")))
    whole_of = targets.select(
        F.col("source").alias("_source"), F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long").alias("whole")
    )
    drawn = rounded.join(whole_of, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    drawn = drawn.withColumn("copies", F.col("whole") + F.col("up"))
    drawn = _made_up(scratch, sure, drawn, targets).select("doc_id", "source", "th", "size", "copies")
    out = sure.unionByName(drawn).join(of, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    return out.select("doc_id", "source", "th", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"))


def mixed(docs: DataFrame, id_column: str, text_column: str, source_column: str, mix: Mix = Mix()) -> DataFrame:
    """The rows of the mix, each as often as it is taken, with the columns of ``docs``.

    Rows that repeat an id, a source and a text are taken together: one of them stands for all.
    """
    scratch = Scratch(docs.sparkSession, "mixed")
    plan = mix_plan(docs, id_column, text_column, source_column, mix)
    keys = ["doc_id", "source", "th"]
    totals = scratch.write(plan.groupBy(*keys).agg(F.sum("copies").alias("copies"), F.count("*").alias("rows")).where("copies > 0"))
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    own = [F.col(id_column).cast("long").alias("_id"), F.col(source_column).cast("string").alias("_source"), F.xxhash64(text).alias("_th")]
    whole = docs.select(F.struct(*docs.columns).alias("row"), *own)
    same = F.col("_id").eqNullSafe(F.col("doc_id")) & F.col("_source").eqNullSafe(F.col("source")) & (F.col("_th") == F.col("th"))
    met = whole.join(totals, same)
    repeated = met.where("rows > 1").groupBy(*keys, "copies").agg(F.min("row").alias("row"))
    once = met.where("rows = 1").select("row", "copies")
    out = once.union(repeated.select("row", "copies"))
    return out.select(F.col("row"), F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("_copy")).select("row.*")
