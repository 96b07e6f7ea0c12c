"""SimHash near-duplicates: exact links within a bit distance, and their components."""

from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringwatch.llm.common import kept_rows, row_keys
from ringwatch.llm.components import components
from ringwatch.session import Scratch, scratch_for

WIDTH = 64
SEED = 42
#: Reference fingerprints of the distance tables.
REFERENCES = 16
#: Larger buckets are cut into parts of about this, every two of which meet in some task.
PART = 1 << 12
#: Fingerprints of one part that are compared with the other in one step.
BLOCK = 512
#: Comparisons, before any is discarded, that a task is given.
PAIRS_PER_TASK = 1 << 29
BUCKETS_PER_TASK = 2000
#: A driver keeps no more tasks than this in hand; beyond it each of them compares more.
MOST_TASKS = 100_000
#: Shingles hashed before their bits are counted.
STEP = 1 << 16

_LOWER = bytes(
    32 if c == 32 or 9 <= c <= 13 else c + 32 if 65 <= c <= 90 else c for c in range(256)
)


def _references(n: int) -> np.ndarray:
    """Fixed points of the fingerprint space, spread evenly by a hash of their number."""
    return np.array([xxhash.xxh64_intdigest(f"reference {i}", SEED) for i in range(n)], dtype=np.uint64)


def fingerprint(text: str | None, shingle: int) -> int:
    """Bitwise majority of the hashes of all word shingles, repeats included.

    A..Z count as a..z, words lie between ASCII white space. Fewer words than a
    shingle needs are one shingle; no word gives 0.
    """
    data = np.frombuffer((text or "").encode("utf-8", "replace").translate(_LOWER), dtype=np.uint8)
    blank = data == 32
    keep = ~blank
    keep[1:] |= ~blank[:-1]
    words = data[keep].tobytes().strip(b" ")
    if not words:
        return 0
    gaps = np.flatnonzero(np.frombuffer(words, dtype=np.uint8) == 32)
    starts = np.concatenate(([0], gaps + 1))
    ends = np.concatenate((gaps, [len(words)]))
    n = max(1, len(starts) - shingle + 1)
    ends = ends[-n:]
    ones = np.zeros(WIDTH, dtype=np.int64)
    for at in range(0, n, STEP):
        spans = zip(starts[at : min(at + STEP, n)].tolist(), ends[at : at + STEP].tolist())
        hashes = [xxhash.xxh64_intdigest(words[a:b], SEED) for a, b in spans]
        octets = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<i8")[0])


def fingerprints(text: Column, shingle: int) -> Column:
    @F.pandas_udf("long")
    def prints(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")

    return prints(text)


def distance_tables() -> list[Callable[[Column], Column]]:
    """Functions of a fingerprint to its distances to eight references each: one byte each, the first lowest."""
    def packed(references: np.ndarray) -> Callable[[Column], Column]:
        def of(fp: Column) -> Column:
            number = F.lit(0).cast("bigint")
            for i, reference in enumerate(references.tolist()):
                distance = F.bit_count(fp.bitwiseXOR(F.lit(reference))).cast("bigint")
                number = number.bitwiseOR(F.shiftleft(distance, 8 * i))
            return number

        return of

    return [packed(_references(REFERENCES).view(np.int64)[at : at + 8]) for at in range(0, REFERENCES, 8)]


@dataclass(frozen=True)
class Part:
    """Fingerprints with their distance tables, in the order of the first distance."""

    prints: np.ndarray
    table: np.ndarray

    @classmethod
    def of(cls, part: dict) -> "Part":
        """From the lists ``fps`` and ``t0`` on, as numpy arrays or as lists."""
        fields = [np.asarray(part[name], np.int64) for name in ("fps", *(f"t{i}" for i in range(REFERENCES // 8)))]
        table = np.column_stack(fields[1:]).astype("<i8").view(np.int8)
        order = np.argsort(table[:, 0], kind="stable")
        return cls(fields[0].view(np.uint64)[order], table[order])


def _close_pairs(left: Part, right: Part, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs within ``bits``, in steps: distance tables first, then the fingerprints themselves.

    By the triangle inequality two fingerprints differ by no less than their distances
    to any reference do, so a pair goes as soon as one coordinate is too far apart. By the first
    coordinate, in whose order both sides are, whole stretches go.
    """
    first = right.table[:, 0]
    for at in range(0, len(left.prints), BLOCK):
        table = left.table[at : at + BLOCK]
        low, high = np.searchsorted(first, table[0, 0] - bits), np.searchsorted(first, table[-1, 0] + bits, side="right")
        for start in range(low, high, BLOCK):
            near = slice(start, min(start + BLOCK, high))
            i, j = np.nonzero(np.abs(table[:, None, 0] - first[None, near]) <= bits)
            for k in range(1, REFERENCES):
                close = np.abs(table[i, k] - right.table[near][j, k]) <= bits
                i, j = i[close], j[close]
            close = np.bitwise_count(left.prints[at + i] ^ right.prints[start + j]) <= bits
            yield at + i[close], start + j[close]


def _smallest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest index that each of ``n`` nodes reaches over the pairs."""
    labels = np.arange(n)
    while True:
        new = labels.copy()
        np.minimum.at(new, i, labels[j])
        np.minimum.at(new, j, labels[i])
        new = new[new]
        if np.array_equal(new, labels):
            return labels
        labels = new


def _connect(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """For each part or pair of parts, a link from every linked fingerprint to the smallest it reaches."""
    for batch in batches:
        for row in batch["parts"]:
            lists = row.values
            sides = [
                Part.of({lists.type[f].name: lists.field(f)[i].values.to_numpy() for f in range(lists.type.num_fields)})
                for i in range(len(lists))
            ]
            left, right = sides[0], sides[-1]
            nodes = left.prints if len(sides) == 1 else np.concatenate([left.prints, right.prints])
            shift = len(nodes) - len(right.prints)
            labels = np.arange(len(nodes))
            for i, j in _close_pairs(left, right, bits):
                known = np.flatnonzero(labels != np.arange(len(nodes)))
                if len(i):
                    labels = _smallest(len(nodes), np.concatenate([known, i]), np.concatenate([labels[known], j + shift]))
            linked = np.flatnonzero(labels != np.arange(len(nodes)))
            if len(linked):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nodes[linked].view(np.int64)), pa.array(nodes[labels[linked]].view(np.int64))], names=["a", "b"]
                )


def _masks(bits: int) -> list[int]:
    """Bit masks of which two fingerprints within ``bits`` agree on at least one.

    Of ``bits + 2`` segments, ``bits`` differing bits leave two untouched.
    """
    edges = [round(i * WIDTH / (bits + 2)) for i in range(bits + 3)]
    segments = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]
    masks = [x | y for x, y in combinations(segments, 2)]
    return [m - (1 << WIDTH) if m >= 1 << (WIDTH - 1) else m for m in masks]


def close_links(prints: DataFrame, bits: int, scratch: Scratch, part: int = PART) -> DataFrame:
    """Links ``a, b`` that connect exactly the fingerprints connected by distances up to ``bits``.

    ``prints`` has distinct ``fp``. Fingerprints are only compared where they agree on
    two whole segments, which no pair within the distance escapes. A bucket of more
    than ``part`` fingerprints is cut into parts by hash, whose pairs are compared
    one by one in any task, so no task holds a bucket; a fingerprint of a hot bucket is sent once for
    every part, not for every other fingerprint. From each pair of parts come
    at most as many links as it has fingerprints, not all its close pairs. The distance tables
    are worked out once per fingerprint and bucket and travel with it.
    """
    keys = F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in _masks(bits)])
    members = prints.select("fp", F.posexplode(keys).alias("mask", "key"))
    buckets = members.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    buckets = scratch.cut(buckets, "buckets")
    split = members.join(buckets, ["mask", "key"]).select(
        "mask", "key", "fp", F.ceil(F.col("n") / part).cast("int").alias("of")
    )
    own = F.pmod(F.xxhash64("fp"), "of").cast("int").alias("part")
    blocks = split.groupBy("mask", "key", "of", own).agg(F.collect_list("fp").alias("fps"))
    tables = [F.transform("fps", table).alias(f"t{i}") for i, table in enumerate(distance_tables())]
    blocks = scratch.cut(blocks.select("mask", "key", "of", "part", F.struct("fps", *tables).alias("fps")), "blocks")
    whole = blocks.filter("of = 1").select(F.array("fps").alias("parts"))
    other = F.explode(F.sequence(F.lit(0), F.col("of") - 1)).alias("other")
    pairs = (
        blocks.filter("of > 1")
        .select("mask", "key", "part", "fps", other)
        .groupBy("mask", "key", F.least("part", "other").alias("lo"), F.greatest("part", "other").alias("hi"))
        .agg(F.collect_list("fps").alias("parts"))
        .select("parts")
    )
    # A few bytes of fingerprints are much work, so tasks are cut by the number of comparisons, not by size.
    n = F.col("n").cast("double")
    work, count = buckets.agg(F.sum(n * n / 2), F.count(F.lit(1))).first()
    tasks = min(1 + int(work or 0) // PAIRS_PER_TASK + count // BUCKETS_PER_TASK, MOST_TASKS)
    dealt = whole.unionByName(pairs).repartition(tasks)
    return dealt.mapInArrow(lambda b: _connect(b, bits), "a long, b long").distinct()


def near_duplicates(
    docs: DataFrame,
    shingle: int = 4,
    bits: int = 4,
    text: str = "text",
    id_col: str = "doc_id",
    carry: Mapping[str, Column] | None = None,
    part: int = PART,
    scratch: Scratch | None = None,
) -> DataFrame:
    """``doc_id, fingerprint, component_id, kept`` and the ``carry`` columns per row of ``docs``.

    Fingerprints link at up to ``bits`` differing bits; ``component_id`` is the smallest
    id reachable over links, ids that are null aside (null if there is no other). Equal
    texts share a fingerprint. Null, empty and blank texts have fingerprint 0 and link
    like any other. ``kept`` marks one row per component, that of the smallest id, null
    ids last, one of several rows with that id. Whole texts are read, in steps of
    bounded memory. An empty table gives an empty result; other columns are ignored.

    Equal fingerprints are one before anything is compared, so copies cost nothing.
    A popular one is a hot key of the last join only, between plain tables.
    """
    scratch = scratch_for(docs, scratch)
    names = list(carry or {})
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("_id"),
        fingerprints(F.col(text).cast("string"), shingle).alias("fp"),
        *[expression.alias(name) for name, expression in (carry or {}).items()],
    ).withColumn("_row", F.monotonically_increasing_id())
    rows = scratch.cut(rows, "fingerprints")
    place = F.struct(F.col("_id").isNull().alias("void"), "_id", "_row")
    prints = scratch.cut(rows.groupBy("fp").agg(F.min(place).alias("first")), "prints")
    links = close_links(prints, bits, scratch, part)
    labels = components(links, scratch)
    linked = prints.join(labels.withColumnRenamed("node", "fp"), "fp")
    firsts = linked.groupBy("label").agg(F.min("first").alias("leader"))
    firsts = scratch.cut(firsts, "firsts")
    leaders = labels.join(firsts, "label").select(F.col("node").alias("fp"), "leader")
    classes = prints.join(leaders, "fp", "left").select(
        "fp", F.coalesce("leader", "first").alias("leader")
    )
    classes = scratch.cut(classes.select("fp", "leader._id", "leader._row").toDF("fp", "_least", "_leader"), "classes")
    return rows.join(classes, "fp").select(
        F.col("_id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("_least").alias("component_id"),
        (F.col("_row") == F.col("_leader")).alias("kept"),
        *names,
    )


def drop_near_duplicates(
    docs: DataFrame,
    shingle: int = 4,
    bits: int = 4,
    text: str = "text",
    id_col: str = "doc_id",
    scratch: Scratch | None = None,
) -> DataFrame:
    """``docs`` with one row of each component, all its columns unchanged."""
    scratch = scratch_for(docs, scratch)
    carry = dict(zip(("_key", "_more"), row_keys(docs)))
    found = near_duplicates(docs, shingle, bits, text, id_col, carry, scratch=scratch)
    return kept_rows(docs, found, scratch)
