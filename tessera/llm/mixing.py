"""Mixing sources to target weights by pivotal dependent rounding, DataFrame functions only.

Every document of a source gets the same expected number of copies, its
source's target over its source's size. The whole part is certain; the
fractional parts are rounded by the pivotal method, two documents at a time:
one gains probability, the other loses it, in proportion to their sizes so
that the expected words of the pair stay the same, until one of them is 0 or 1;
the direction is drawn so that each probability is kept in expectation. The
other goes on against the next document, and the one that is left at the end is
drawn alone: a source misses its target by less than that document.

So large documents come first. Those of more than a ``FINE``-th of the target and
a ``COARSE``-th of the source (fewer than ``COARSE``) are paired, in falling size,
with all that is left of their source as one: the document is drawn, and what it
gains or loses is spread over the rest by moving their rate. It takes the number
of copies (the whole part of the rate, or one more) that leaves the rest a rate
between 0 and ``most``; where both do, its draw decides. A source of few
documents is settled in this way altogether, to within its smallest one.

The other documents of a source are dealt by hash to groups of about ``FAN_IN``; a
group is folded in one expression and leaves one undecided document, which
goes to the next level of the reduction tree; a hot source is just many
groups. All draws are hashes of ``doc_id`` and ``seed``: reruns agree.

Edge cases: a null text has size 0; documents of size 0 take no words; a null
source is a source; repeated rows (and rows with a null ``doc_id``) are
documents of their own; extra columns are ignored; an empty table gives none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import WORD_RE, materialise

FAN_IN = 256
#: Parts of a source's target, and of its size, above which a document is settled first.
FINE, COARSE = 256, 1024
WEIGHTS = (5.0, 2.0, 1.0)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_RE)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, share: float = 1.5, most: float = 2.0,
                   weights: tuple = WEIGHTS) -> DataFrame:
    """Target words of each source from ``sizes(source, size)``: source, source_size, target.

    ``weights`` repeat over the sources in code point order, null last. A
    target stops at ``most`` times the source's size and the excess is shared
    again by weight until none is above, which fills sources in the order of
    their limit a weight up to one level.
    """
    per = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"), F.count(F.lit(1)).alias("docs"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (rank % len(weights) + 1).cast("int"))
    per = per.withColumn("weight", weight).withColumn("limit", F.lit(most) * F.col("source_size"))
    filling = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    full = F.sum("limit").over(filling.rowsBetween(Window.unboundedPreceding, -1))
    rest = F.sum("weight").over(filling.rowsBetween(0, Window.unboundedFollowing))
    total = F.lit(share) * F.sum("source_size").over(Window.partitionBy())
    per = per.withColumn("level", (total - F.coalesce(full, F.lit(0.0))) / rest)
    per = per.withColumn("above", F.col("level") < F.col("limit") / F.col("weight"))
    level = F.max(F.struct("above", F.when(F.col("above"), -F.col("at")).otherwise(F.col("at")).alias("o"), "level")).over(Window.partitionBy())
    per = per.withColumn("at", F.row_number().over(filling)).withColumn("last", level)
    return per.select("source", "source_size", "docs",
                      F.when(F.col("last.above"), F.least(F.col("limit"), F.col("last.level") * F.col("weight")))
                      .otherwise(F.col("limit")).alias("target"))


def _draw(seed: int, level: int, *cols) -> Column:
    """A number in [0, 1) that depends on the columns only."""
    h = F.xxhash64(F.lit(seed), F.lit(level), *cols)
    return F.shiftrightunsigned(h, 11).cast("double") / F.lit(float(1 << 53))


_ITEM = "struct<doc_id:bigint,key:bigint,n:int,size:bigint,base:bigint,p:double>"
_KEPT = ("doc_id", "key", "n", "size", "base")


def _step(state: Column, x: Column) -> Column:
    """Carry one document against the next: state = (held, done)."""
    held = state["held"]
    a, b, s, t, u = held["p"], x["p"], held["size"].cast("double"), x["size"].cast("double"), x["u"]
    up = F.least((1.0 - a) * s, b * t)          # held gains, x loses
    down = F.least(a * s, (1.0 - b) * t)        # held loses, x gains
    gains = u * (up + down) < down
    held_to = F.when(gains, F.when((1.0 - a) * s <= b * t, F.lit(1.0)).otherwise(F.least(F.lit(1.0), a + b * t / s))) \
        .otherwise(F.when(a * s <= (1.0 - b) * t, F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), a - (1.0 - b) * t / s)))
    x_to = F.when(gains, F.when((1.0 - a) * s <= b * t, F.greatest(F.lit(0.0), b - (1.0 - a) * s / t)).otherwise(F.lit(0.0))) \
        .otherwise(F.when(a * s <= (1.0 - b) * t, F.least(F.lit(1.0), b + a * s / t)).otherwise(F.lit(1.0)))

    def item(y, p):
        return F.struct(*[y[c].alias(c) for c in _KEPT], p.alias("p"))

    fresh = F.struct(item(x, b).alias("held"), state["done"].alias("done"))
    held_done = (held_to == 0.0) | (held_to == 1.0)
    pair = F.struct(
        F.when(held_done, item(x, x_to)).otherwise(item(held, held_to)).alias("held"),
        F.concat(state["done"], F.array(F.when(held_done, item(held, held_to)).otherwise(item(x, x_to)))).alias("done"))
    whole = F.struct(item(x, b).alias("held"), F.concat(state["done"], F.array(held)).alias("done"))
    return F.when(held.isNull(), fresh).when((a == 0.0) | (a == 1.0), whole).otherwise(pair)


def pivotal_round(items: DataFrame, seed: int = 7, fan_in: int = FAN_IN) -> DataFrame:
    """Round ``items(source, docs, doc_id, key, n, size, base, p)``: source, doc_id, key, n, size, copies.

    ``copies`` is base + 0 or 1; ``p`` in [0, 1], size above 0; (key, n) names a
    row; ``docs`` bounds the rows of a source.
    """
    kept = ("source", "doc_id", "key", "n", "size")
    out = items.where("p = 0 or p = 1").select(*kept, (F.col("base") + F.col("p")).cast("long").alias("copies"))
    todo, level = items.where("p > 0 and p < 1"), 0
    while True:
        groups = F.greatest(F.lit(1), F.ceil(F.col("docs") / fan_in)).cast("long")
        # large documents first: the many small ones after them bring the held probability to 0 or 1
        row = F.struct("size", "key", "n", "doc_id", "base", "p", _draw(seed, 2 * level, "key", "n").alias("u"))
        folded = materialise(
            todo.withColumn("g", F.pmod(F.xxhash64(F.lit(seed), F.lit(level), "key", "n"), groups))
            .groupBy("source", "g").agg(F.sort_array(F.collect_list(row), asc=False).alias("rows"), F.max("docs").alias("docs"))
            .withColumn("end", F.aggregate(
                "rows", F.struct(F.lit(None).cast(_ITEM).alias("held"), F.array().cast(f"array<{_ITEM}>").alias("done")), _step))
            .select("source", "docs", "end.held", "end.done"), "mixing-level")
        out = out.union(folded.select("source", F.explode("done").alias("x")).select(
            "source", "x.doc_id", "x.key", "x.n", "x.size", (F.col("x.base") + F.col("x.p")).cast("long")))
        todo = folded.select("source", F.ceil(F.col("docs") / fan_in).alias("docs"), "held.*")
        if folded.groupBy("source").count().where("count > 1").isEmpty():
            # one document of a source is undecided at most: it is drawn alone
            won = (F.col("p") > _draw(seed, 2 * level + 1, "key", "n")).cast("long")
            return out.union(todo.select(*kept, F.col("base") + won))
        level += 1


def row_names(docs: DataFrame) -> DataFrame:
    """Adds ``key``, a hash of doc_id, source and text."""
    key = F.xxhash64(F.col("doc_id").cast("long"), F.col("source").cast("string"), F.col("text").cast("string"))
    return docs.withColumn("key", key)


def numbered(rows: DataFrame) -> DataFrame:
    """Adds ``n``, the row's number among those of equal key, from 1 (streamed, not collected)."""
    return rows.withColumn("n", F.row_number().over(Window.partitionBy("key").orderBy("key")))


def settle_large(large: DataFrame, most: float = 2.0, seed: int = 7) -> tuple[DataFrame, DataFrame]:
    """Copies of ``large(source, docs, source_size, target, doc_id, key, n, size)`` and, by source, the rate of what is left.

    A state holds the words still to take and the words still there; the first
    is kept between 0 and ``most`` times the second wherever a document allows it.
    """
    row = F.struct("size", "key", "n", "doc_id", _draw(seed, -1, "key", "n").alias("u"))
    done_type = "array<struct<doc_id:bigint,key:bigint,n:int,size:bigint,copies:bigint>>"

    def step(state, x):
        left, there, s = state["left"], state["there"], x["size"].cast("double")
        rate = left / there
        low = F.floor(rate).cast("long")
        rest = there - s

        def beyond(copies):
            """Words by which the rest can't make up for this number of copies."""
            after = left - copies * s
            return F.greatest(-after, after - F.lit(most) * rest, F.lit(0.0))

        up, down = beyond(low + 1), beyond(low)
        more = F.when(low >= int(most), False).when(up == down, x["u"] < rate - low).otherwise(up < down)
        copies = low + more.cast("long")
        after = F.least(F.greatest(left - copies * s, F.lit(0.0)), F.lit(most) * rest)
        taken = F.struct(x["doc_id"].alias("doc_id"), x["key"].alias("key"), x["n"].alias("n"), x["size"].alias("size"), copies.alias("copies"))
        return F.struct(after.alias("left"), rest.alias("there"), F.concat(state["done"], F.array(taken)).alias("done"))

    start = F.struct(F.col("target").alias("left"), F.col("source_size").cast("double").alias("there"), F.array().cast(done_type).alias("done"))
    ends = materialise(
        large.groupBy("source", "target", "source_size").agg(F.sort_array(F.collect_list(row), asc=False).alias("rows"))
        .withColumn("end", F.aggregate("rows", start, step)).select("source", "end"), "mixing-large")
    copies = ends.select("source", F.explode("end.done").alias("x")).select("source", "x.doc_id", "x.key", "x.n", "x.size", "x.copies")
    return copies, ends.select("source", F.when(F.col("end.there") > 0, F.col("end.left") / F.col("end.there")).otherwise(0.0).alias("rest_rate"))


def mix(docs: DataFrame, share: float = 1.5, most: float = 2.0, seed: int = 7,
        weights: tuple = WEIGHTS, fan_in: int = FAN_IN) -> DataFrame:
    """Copies of every document: doc_id, key, n, source, size, source_size, target, copies."""
    sized = row_names(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), "text"))
    sized = materialise(numbered(sized.select("doc_id", "source", "key", word_count(F.col("text").cast("string")).alias("size"))), "mixing-sizes")
    targets = materialise(source_targets(sized, share, most, weights), "mixing-targets")
    same = sized["source"].eqNullSafe(targets["source"])
    limit = F.greatest(F.col("target") / FINE, F.col("source_size") / COARSE)
    each = sized.join(targets, same).select(sized["source"], "doc_id", "key", "n", "size", "docs", "source_size", "target", (F.col("size") > limit).alias("large"))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    settled, rates = settle_large(each.where("large and size > 0"), most, seed)
    small = each.where("not large and size > 0")
    small = small.join(rates, small["source"].eqNullSafe(rates["source"]), "left").select(
        small["source"], "docs", "doc_id", "key", "n", "size", F.coalesce("rest_rate", F.col("target") / F.col("source_size")).alias("rate"))
    base = F.floor("rate").cast("long")
    items = small.select("source", "docs", "doc_id", "key", "n", "size", base.alias("base"), (F.col("rate") - base).alias("p"))
    empty = each.where("size = 0").select("source", "doc_id", "key", "n", "size", whole.alias("copies"))
    rounded = pivotal_round(items, seed, fan_in).union(settled).union(empty)
    return rounded.join(targets, rounded["source"].eqNullSafe(targets["source"])).select(
        "doc_id", "key", "n", rounded["source"], "size", "source_size", "target", "copies")
