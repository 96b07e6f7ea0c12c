"""Mixing sources to target weights along a training run. DataFrame functions only.

Each source has a weight schedule over the run. Its integral is the source's share
of the words; inverting the cumulative demand gives every document the point of the
run at which the words before it in its source have been used up. Sorting the
documents of all sources by that point is the training order.
"""

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ringwatch.llm.common import free_name, row_keys, word_count
from ringwatch.session import Scratch, scratch_for


@dataclass(frozen=True)
class Schedule:
    """Weight of a source: its integral ``share``, and its shape as (time, height) knots.

    Times run from 0 to 1; between knots the height is linear. The shape is scaled to
    an integral of 1, so heights are relative.
    """

    share: float
    knots: tuple[tuple[float, float], ...] = ((0.0, 1.0), (1.0, 1.0))

    def areas(self) -> list[float]:
        """Integral of the shape up to each knot."""
        total = [0.0]
        for (t, y), (u, z) in zip(self.knots, self.knots[1:]):
            total.append(total[-1] + (u - t) * (y + z) / 2)
        return total

    def time_of(self, used: Column) -> Column:
        """The time by which the fraction ``used`` of the source's words is spent."""
        areas = self.areas()
        result = None
        for i, ((t, y), (u, z)) in reversed(list(enumerate(zip(self.knots, self.knots[1:])))):
            slope = (z - y) / (u - t)
            rest = used * F.lit(areas[-1]) - F.lit(areas[i])
            root = F.sqrt(F.greatest(F.lit(y * y) + F.lit(2 * slope) * rest, F.lit(0.0)))
            inside = F.lit(t) + F.when(rest > 0, 2 * rest / (F.lit(y) + root)).otherwise(0.0)
            here = used * F.lit(areas[-1]) < F.lit(areas[i + 1])
            result = inside if result is None else F.when(here, inside).otherwise(result)
        return F.least(result, F.lit(1.0))


#: Sources take these in turn, in code-point order: early, steady and late ones.
CURRICULUM = (
    Schedule(5.0, ((0.0, 1.5), (1.0, 0.5))),
    Schedule(2.0),
    Schedule(1.0, ((0.0, 0.5), (0.5, 1.0), (1.0, 1.5))),
)


def _rank(sources: DataFrame, scratch: Scratch) -> DataFrame:
    """``_rank`` from 0 in code-point order, null last, however many sources there are.

    The sources are range-sorted and written; a row's number in its part plus the
    sizes of the parts before it is its rank, so only one row per part meets.
    """
    ordered = sources.withColumn("_void", F.col("_source").isNull())
    ordered = ordered.repartitionByRange("_void", "_source").sortWithinPartitions("_void", "_source")
    ordered = scratch.cut(ordered.withColumn("_place", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("_place", 33).alias("_part")
    parts = ordered.groupBy(part).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    return ordered.select("*", part).join(starts, "_part").select(
        "_source_key", "_source", "source_size", (F.col("_start") + inside).alias("_rank")
    )


def fill_targets(sources: DataFrame, budget: float, most: float, scratch: Scratch) -> DataFrame:
    """Adds ``target``: the budget shared by ``_share``, no source above ``most`` times its size.

    What a full source cannot take is shared again among the others by weight until
    none is above. In each round a source is full if its limit per weight is at most
    the level reached; three sums per round come to the driver, and the level only
    rises, so the rounds end when no further source fills up.
    """
    limit = F.col("source_size") * F.lit(float(most))
    level, full = 0.0, -1
    while True:
        is_full = limit <= F.lit(level) * F.col("_share")
        now = sources.agg(
            F.count_if(is_full).alias("full"),
            F.sum(F.when(is_full, limit)).alias("used"),
            F.sum(F.when(~is_full, F.col("_share"))).alias("open"),
        ).first()
        if now.full == full or not now.open:
            break
        full, level = now.full, (budget - (now.used or 0.0)) / now.open
    capped = limit <= F.lit(level) * F.col("_share")
    if not now.open:
        capped = F.lit(True)
    return sources.withColumn("target", F.when(capped, limit).otherwise(F.lit(level) * F.col("_share")))


def _walk(docs, curriculum, ratio, most, text, id_col, source, carry, scratch) -> DataFrame:
    """Every document with its target, the words before it in its source, and the words taken."""
    scratch = scratch_for(docs, scratch)
    names = list(carry or {})
    name = F.col(source).cast("string")
    sized = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.coalesce(F.concat(F.lit("="), name), F.lit("")).alias("_source_key"),
        word_count(F.col(text)).alias("size"),
        F.coalesce(F.md5(F.col(id_col).cast("bigint").cast("string")), F.lit("")).alias("_order"),
        *[expression.alias(n) for n, expression in (carry or {}).items()],
    )
    sized = scratch.cut(sized, "sized")
    blocks = max(1, math.isqrt(sized.count()))
    high = F.coalesce(F.conv(F.substring("_order", 1, 8), 16, 10).cast("bigint"), F.lit(0))
    sized = sized.withColumn("_block", F.shiftright(high * F.lit(blocks), 32))

    totals = sized.groupBy("_source_key", "_block").agg(F.sum("size").alias("_words"))
    totals = scratch.cut(totals, "totals")
    sources = totals.groupBy("_source_key").agg(F.sum("_words").alias("source_size"))
    sources = sources.withColumn("_source", F.when(F.col("_source_key") != "", F.substr("_source_key", F.lit(2))))
    turn = F.pmod("_rank", F.lit(len(curriculum)))
    shares = F.element_at(F.array(*[F.lit(s.share) for s in curriculum]), (turn + 1).cast("int"))
    ranked = _rank(sources, scratch).select("*", turn.alias("_turn"), shares.alias("_share"))
    ranked = scratch.cut(ranked, "ranked")
    budget = ratio * (ranked.agg(F.sum("source_size")).first()[0] or 0)
    targets = fill_targets(ranked, budget, most, scratch)

    before = Window.partitionBy("_source_key").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        "_source_key", "_block", F.coalesce(F.sum("_words").over(before), F.lit(0)).alias("_start")
    ).join(targets.select("_source_key", "source_size", "target", "_turn"), "_source_key")
    inside = (
        Window.partitionBy("_source_key", "_block")
        .orderBy("_order", "doc_id", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    walked = sized.withColumn("_inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    walked = walked.join(scratch.cut(starts, "starts"), ["_source_key", "_block"])

    wanted = F.floor(F.col("target") + 0.5).cast("bigint")
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("_wanted") / F.col("source_size"))).otherwise(0)
    rest = F.col("_wanted") - F.col("_passes") * F.col("source_size") - F.col("_before")
    taken = F.col("_passes") * F.col("size") + F.greatest(F.least(rest, F.col("size")), F.lit(0))
    return (
        walked.withColumn("_before", F.col("_start") + F.col("_inside"))
        .withColumn("_wanted", wanted)
        .withColumn("_passes", passes.cast("bigint"))
        .withColumn("taken", taken.cast("bigint"))
    )


def _position(curriculum: tuple[Schedule, ...], words_before: Column) -> Column:
    """Where in the run the source has used up ``words_before``; null where nothing is taken."""
    used = F.when(F.col("taken") > 0, words_before / F.nullif(F.col("_wanted"), F.lit(0)))
    position = None
    for i, schedule in reversed(list(enumerate(curriculum))):
        when = schedule.time_of(used)
        position = when if position is None else F.when(F.col("_turn") == i, when).otherwise(position)
    return F.when(F.col("taken") > 0, position)


def mix(
    docs: DataFrame,
    curriculum: tuple[Schedule, ...] = CURRICULUM,
    ratio: float = 1.5,
    most: float = 2.0,
    text: str = "text",
    id_col: str = "doc_id",
    source: str = "source",
    carry: dict[str, Column] | None = None,
    scratch: Scratch | None = None,
) -> DataFrame:
    """How many words the mix takes of every document, and when.

    Returns one row per row of ``docs``: ``doc_id, size, source_size, target, taken,
    position`` and the ``carry`` columns. ``size`` counts the words between ASCII
    white space, null texts have none. Sources take the curriculum's schedules in
    turn, by code point, null last; together they are due ``ratio`` times all words,
    none more than ``most`` times its own. ``taken`` walks the source in the order of
    md5(doc_id) as often as its target asks for and stops at the word where the
    rounded target is met, so a source's taken words sum to it. ``position`` (0 to 1)
    is where in the run the first pass over the document starts, null if it is not
    taken. Rows that repeat an id are taken one after the other; null ids come first
    in order of their size. Without words every target is 0; an empty table gives an
    empty result; other columns of ``docs`` are ignored.

    The order within a source is cut into blocks of hash ranges, about the square
    root of the row count of them, whose totals are summed ahead; a hot source is
    spread over its blocks.
    """
    walked = _walk(docs, curriculum, ratio, most, text, id_col, source, carry, scratch_for(docs, scratch))
    return walked.select(
        "doc_id", "size", F.col("source_size").cast("bigint").alias("source_size"),
        F.col("target").cast("double").alias("target"), "taken",
        _position(curriculum, F.col("_before")).alias("position"), *(carry or {}),
    )


def in_training_order(mixed: DataFrame) -> DataFrame:
    """Range-sorted by position; documents that are not taken follow, spread by their id."""
    rest = 2 + F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / (1 << 20)
    return mixed.orderBy(F.coalesce("position", rest), "doc_id")


def mixed_documents(
    docs: DataFrame,
    curriculum: tuple[Schedule, ...] = CURRICULUM,
    ratio: float = 1.5,
    most: float = 2.0,
    text: str = "text",
    id_col: str = "doc_id",
    source: str = "source",
    scratch: Scratch | None = None,
) -> DataFrame:
    """``docs`` as the mix takes them: one row per pass over a document, in training order.

    A pass that stops inside a document keeps it whole if it takes at least half of
    its words, and else leaves it out. Documents without words are never taken. All
    columns of ``docs`` are returned unchanged. For the other cases see ``mix``.

    The order is worked out on keys alone; the documents then move twice, to their
    passes and to their place.
    """
    scratch = scratch_for(docs, scratch)
    carry = dict(zip(("_key", "_more"), row_keys(docs)))
    walked = _walk(docs, curriculum, ratio, most, text, id_col, source, carry, scratch)
    walked = scratch.cut(walked.drop("_start", "_inside", "_order", "_block", "_source_key"), "walked")
    times = F.floor(F.col("taken") / F.nullif(F.col("size"), F.lit(0)) + 0.5).cast("int")
    counted = walked.filter("taken > 0").withColumn("_times", times).filter("_times > 0")
    passes = counted.select("*", F.explode(F.sequence(F.lit(0), F.col("_times") - 1)).alias("_pass"))
    words_before = F.col("_before") + F.col("_pass") * F.col("source_size")
    names = [free_name(docs, n) for n in ("_key", "_more")]
    at, by = free_name(docs, "_at"), free_name(docs, "_by")
    placed = passes.select(
        F.col("_key").alias(names[0]), F.col("_more").alias(names[1]),
        _position(curriculum, words_before).alias(at), F.col("doc_id").alias(by),
    )
    marked = docs.withColumns(dict(zip(names, row_keys(docs))))
    if not walked.groupBy("_key", "_more").count().filter("count > 1").isEmpty():
        # Rows that are equal throughout: each of their passes takes any one of them.
        marked = marked.dropDuplicates(names)
    ordered = marked.join(placed, names).repartitionByRange(at, by).sortWithinPartitions(at, by)
    return ordered.select(*[F.col(f"`{c}`") for c in docs.columns])
