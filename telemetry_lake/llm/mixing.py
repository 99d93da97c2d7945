"""Mixing sources to target weights by capped water-filling.

Each source gets a share of the mix by its weight, but never more than ``max_epochs`` times its own
size. Sources that reach this limit are clamped, and what they leave is shared out among the others
by weight until none is above its limit. A target is then met by whole repetitions of the source and
one fractional repetition, a seeded sample of whole documents, which a few single documents and
exchanges of one document for another bring close to the target.

Only sources, buckets of hash values, the documents of one bucket per source and the different sizes in
a source are ever ordered; a source that holds a third of all rows is cut into ``16 ** BUCKET_DIGITS`` buckets like any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from .columns import boxed, n_words
from .store import written

#: Leading hexadecimal digits of the sampling key that name a bucket.
BUCKET_DIGITS = 3
#: Single documents that may be added after the sample to come closer to the target: the largest that
#: fit, and at last the one that comes closest, even if it exceeds the target.
FILL_ROUNDS = 4
#: Exchanges of a document of the sample for one outside it that may follow.
EXCHANGE_ROUNDS = 3
PLAN = ["source_size", "target", "whole", "last_key", "extra_keys", "dropped_keys"]


def sampling_key(doc_id: Column, content: Column, seed: str) -> Column:
    """Seeded order of the documents: the same for every run and any partitioning. Rows with the same id, or
    without one, are told apart by their ``content``."""
    return F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("null")), content))


def in_sample(key: Column, prefix: str = "") -> Column:
    """Whether a key is in the fractional repetition by the plan beside it."""
    last, extra, dropped = (F.col(prefix + c) for c in ("last_key", "extra_keys", "dropped_keys"))
    return ((key <= last) | F.array_contains(extra, key)) & ~F.array_contains(dropped, key)


def sized(docs: DataFrame, seed: str, by_text: bool = True) -> DataFrame:
    """``docs`` with ``__size`` (words) and ``__key`` (sampling key, by the text's hash or by its size alone)."""
    content = F.md5(F.coalesce(F.col("text"), F.lit(""))) if by_text else F.col("__size").cast("string")
    return docs.withColumn("__size", n_words(F.col("text"))).withColumn(
        "__key", sampling_key(F.col("doc_id"), content, seed)
    )


def water_level(sources: DataFrame, max_epochs: int) -> float:
    """Words per unit of weight. ``sources`` has ``source_size`` and ``weight``, one row per source.

    Each round is one aggregate over the sources; it clamps at least one more source or ends.
    """
    cap = F.col("source_size") * max_epochs
    total = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    level = 0.0
    while True:
        # At the start nothing is clamped: the comparison with level 0 only holds for empty sources.
        clamped = cap <= F.col("weight") * F.lit(level)
        capped, free = sources.agg(
            F.coalesce(F.sum(F.when(clamped, cap)), F.lit(0)), F.coalesce(F.sum(F.when(~clamped, F.col("weight"))), F.lit(0))
        ).first()
        if not free:
            return float("inf")
        new = (total - capped) / free
        if new <= level:
            return level
        level = new


def source_plan(
    rows: DataFrame, weights: Sequence[int], max_epochs: int, exchanges: int = EXCHANGE_ROUNDS
) -> DataFrame:
    """One row per source: ``source``, and :data:`PLAN`.

    ``rows`` has ``source``, ``__size`` and ``__key`` of every document. A document is in the
    fractional repetition if its key is at most ``last_key`` or one of ``extra_keys``, and none of
    ``dropped_keys``. Rows of one source with the same key count as one document of their common size.
    """
    by_source = rows.groupBy("source").agg(F.sum("__size").alias("source_size"))
    # One row per source in one ordered list: the weights follow the order of the names.
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (rank % len(weights) + 1).cast("int"))
    sources = written(by_source.withColumn("weight", weight), "mixing-sources")
    level = water_level(sources, max_epochs)
    cap = (F.col("source_size") * max_epochs).cast("double")
    target = F.least(cap, F.col("weight") * F.lit(level)) if level != float("inf") else cap
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0).cast("bigint"))
    sources = sources.select("source", "source_size", target.alias("target")).withColumn("whole", whole)
    sources = sources.withColumn("__rest", F.col("target") - F.col("whole") * F.col("source_size"))

    units = rows.filter("__size > 0").groupBy("source", "__key").agg(F.sum("__size").alias("__size"))
    counted = written(units, "mixing-units").withColumn("__bucket", F.substring("__key", 1, BUCKET_DIGITS))
    buckets = counted.groupBy("source", "__bucket").agg(F.sum("__size").alias("__words"))
    upto = F.sum("__words").over(Window.partitionBy("source").orderBy("__bucket"))
    buckets = buckets.withColumn("__before", upto - F.col("__words"))
    s, b = sources.alias("s"), buckets.alias("b")
    cut = (
        s.join(b, F.col("s.source").eqNullSafe(F.col("b.source")))
        .filter("__before <= __rest AND __before + __words > __rest")
        .select("s.source", "__bucket", "__before", "__rest")
    )
    c, r = cut.alias("c"), counted.alias("r")
    in_cut = c.join(r, F.col("c.source").eqNullSafe(F.col("r.source")) & (F.col("c.__bucket") == F.col("r.__bucket"))).select(
        "c.source", "c.__bucket", "__before", "__rest", "__key", "__size"
    )
    order = Window.partitionBy("source").orderBy("__key").rangeBetween(Window.unboundedPreceding, 0)
    last = (
        in_cut.withColumn("__upto", F.col("__before") + F.sum("__size").over(order))
        .groupBy("source")
        .agg(
            F.max(F.when(F.col("__upto") <= F.col("__rest"), F.col("__key"))).alias("__in_cut"),
            F.max(F.when(F.col("__upto") <= F.col("__rest"), F.col("__upto"))).alias("__upto"),
            F.first("__bucket").alias("__bucket"),
            F.first("__before").alias("__before"),
        )
        .select(
            F.col("source").alias("__source"),
            F.coalesce("__in_cut", "__bucket").alias("last_key"),  # a bucket's name sorts before its keys
            F.coalesce("__upto", "__before").alias("__got"),
        )
    )
    plan = sources.join(last, F.col("source").eqNullSafe(F.col("__source")), "left").select(
        "source", "source_size", "target", "whole", "__rest",
        F.coalesce("last_key", F.lit("")).alias("last_key"), F.coalesce("__got", F.lit(0)).alias("__got"),
        F.array().cast("array<string>").alias("extra_keys"), F.array().cast("array<string>").alias("dropped_keys"),
    )
    for k in range(FILL_ROUNDS):
        plan = written(plan, "mixing-plan")
        p, r = plan.alias("p"), counted.alias("r")
        left_out = (
            r.join(p, F.col("p.source").eqNullSafe(F.col("r.source")))
            .filter("__key > last_key AND NOT array_contains(extra_keys, __key)")
            .filter(F.col("__size") <= (F.col("__rest") - F.col("__got")) * (2 if k + 1 == FILL_ROUNDS else 1))
            .groupBy("p.source")
            .agg(F.min(F.struct(F.abs(F.col("__rest") - F.col("__got") - F.col("__size")).alias("__off"), "__size", "__key")).alias("__best"))
            .withColumnRenamed("source", "__source")
        )
        plan = plan.join(left_out, F.col("source").eqNullSafe(F.col("__source")), "left").select(
            "source", "source_size", "target", "whole", "__rest", "last_key",
            (F.col("__got") + F.coalesce(F.col("__best.__size"), F.lit(0))).alias("__got"),
            F.when(F.col("__best").isNull(), F.col("extra_keys"))
            .otherwise(F.concat("extra_keys", F.array("__best.__key")))
            .alias("extra_keys"),
            "dropped_keys",
        )
    for _ in range(exchanges):
        plan = exchanged(written(plan, "mixing-plan"), counted)
    return written(plan.select("source", *PLAN), "mixing-plan")


def exchanged(plan: DataFrame, units: DataFrame) -> DataFrame:
    """``plan`` after one exchange per source, where one brings the sample closer to what it should hold.

    A document that goes wants one in its place whose size differs from its own by what the sample
    lacks. Both sides are put in one order by size, one document of each size; the nearest
    on both sides of the wanted size are looked at.
    """
    p, u = plan.alias("p"), units.alias("u")
    met = p.join(u, F.col("p.source").eqNullSafe(F.col("u.source"))).filter("__rest <> __got").filter(
        ~F.array_contains("dropped_keys", F.col("__key"))
    )
    lacks = F.col("__rest") - F.col("__got")
    sizes = met.groupBy(F.col("p.source").alias("source"), lacks.alias("__lacks"), in_sample(F.col("__key")).alias("__in"), "__size").agg(
        F.min("__key").alias("__key")
    )
    sizes = sizes.withColumn("__at", F.col("__size") + F.when(F.col("__in"), F.col("__lacks")).otherwise(0))
    other = F.when(~F.col("__in"), F.struct(F.col("__size").alias("size"), F.col("__key").alias("key")))
    order = Window.partitionBy("source").orderBy("__at")
    below = F.last(other, ignorenulls=True).over(order.rangeBetween(Window.unboundedPreceding, 0))
    above = F.first(other, ignorenulls=True).over(order.rangeBetween(0, Window.unboundedFollowing))
    near = sizes.withColumn("__other", F.array(below, above)).filter("__in").withColumn("__other", F.explode("__other"))
    off = F.abs(F.col("__at") - F.col("__other.size"))
    best = (
        near.filter(off < F.abs("__lacks"))
        .groupBy(F.col("source").alias("__source"))
        .agg(F.min(F.struct(off.alias("off"), "__size", "__key", "__other")).alias("__best"))
    )

    def with_key(keys: str, key: str) -> Column:
        return F.when(F.col("__best").isNull(), F.col(keys)).otherwise(F.concat(keys, F.array(key))).alias(keys)

    gained = F.coalesce(F.col("__best.__other.size") - F.col("__best.__size"), F.lit(0))
    return plan.join(best, F.col("source").eqNullSafe(F.col("__source")), "left").select(
        "source", "source_size", "target", "whole", "__rest", "last_key", (F.col("__got") + gained).alias("__got"),
        with_key("extra_keys", "__best.__other.key"), with_key("dropped_keys", "__best.__key"),
    )


def repetitions(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``rows`` with ``__plan``, the :data:`PLAN` of its source, and ``__times``, how often the mix takes it."""
    p = plan.select(F.col("source").alias("__source"), F.struct(*PLAN).alias("__plan"))
    chosen = in_sample(F.col("__key"), "__plan.")
    times = F.when(F.col("__size") > 0, F.col("__plan.whole") + chosen.cast("bigint")).otherwise(F.lit(0).cast("bigint"))
    return rows.join(p, rows["source"].eqNullSafe(p["__source"]), "left").withColumn("__times", times)


def mix(docs: DataFrame, weights: Sequence[int] = (1, 2, 3), max_epochs: int = 3, seed: str = "mix-1") -> DataFrame:
    """What a mix of all words takes of each document.

    Sources in the order of their code points, null last, weigh ``weights`` in turn. Returns one row
    per row of ``docs``: ``doc_id``, ``size`` (words; 0 for null or blank texts), ``source_size``,
    ``target`` (words wanted of its source), ``taken`` (words taken, repetitions counted; a multiple
    of ``size``, at most ``max_epochs`` times it). Rows that repeat both id and text share
    their fate, as do those without an id that have the same text. An empty table gives an empty result;
    further columns are ignored.
    """
    rows = written(sized(docs.select("doc_id", "source", "text"), seed).drop("text"), "mixing-sizes")
    taken = repetitions(rows, source_plan(rows, weights, max_epochs))
    return taken.select(
        "doc_id", F.col("__size").alias("size"), "__plan.source_size", "__plan.target", (F.col("__size") * F.col("__times")).alias("taken")
    )


def mixed_documents(
    docs: DataFrame, weights: Sequence[int] = (1, 2, 3), max_epochs: int = 3, seed: str = "mix-1", by_text: bool = True,
    exchanges: int = EXCHANGE_ROUNDS,
) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as the mix takes it, all its columns kept, whatever their names.

    Without ``by_text`` the sample goes by id and size alone, and texts are not hashed: for tables whose rows have ids.
    """
    sizes = written(sized(docs.select("doc_id", "source", "text"), seed, by_text).drop("text"), "mixing-sizes")
    plan = source_plan(sizes, weights, max_epochs, exchanges)
    rows = repetitions(sized(boxed(docs, "doc_id", "source", "text"), seed, by_text), plan)
    # The outer form, as the other lets the optimizer add a filter that counts the words once more.
    copies = F.explode_outer(F.array_repeat(F.lit(True), F.col("__times").cast("int")))
    return rows.select("row", copies.alias("__copy")).filter("__copy").select("row.*")
