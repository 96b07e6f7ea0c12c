"""Phrase collocations: Misra-Gries summaries per hash partition, then an exact count of what survives.

The first pass knows n-grams by a 64-bit hash: the upper half names a hash partition, the lower half the n-gram in it. Tasks
summarise their own texts, and the summaries of a partition are merged at a capacity beyond the
partition's mass divided by the threshold, so no n-gram of that frequency is lost. What survives
is a bit map. The second pass counts the n-grams whose bit is set, as texts, and drops those that
turn out rarer: a collision of hashes or of bits costs a little work and changes no count.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ringwatch.session import Scratch, scratch_for

# What ends a piece, and what stands between words.
PIECE_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
GAPS = b" \x09"
UNKNOWN_LANG = "und"

#: Bytes of text that are hashed at once.
CHUNK = 512 << 10
#: Summary entries that a task holds before it hands them on.
HELD = 512 << 10
#: A counted hash of a partition is known by as many of its lower bits.
KEY_BITS = 32
#: Bytes of text for each hash partition; at most 1.5 n-grams of up to three words start at a byte.
PARTITION_BYTES = 8 << 20
LEAST_PARTITIONS = 8
#: Parts of a language that are ranked apart; the first rows of each are then ranked together.
RANK_PARTS = 128
#: Bits of all maps together, which are broadcast.
MOST_BITS = 1 << 28

_LOWER = bytes(
    ord("\n") if byte in PIECE_ENDS else ord(" ") if byte in GAPS else byte + 32 if 65 <= byte <= 90 else byte
    for byte in range(256)
)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


class _Hasher:
    """Hashes of all words of a chunk at once: one lane is a 64-bit hash, two are 128 bits."""

    def __init__(self, lanes: int):
        seeds = np.arange(1, 257 * lanes + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        numbers = _mixed(seeds).reshape(lanes, 257)
        self.values, self.bases = numbers[:, :256], [int(b) | 1 for b in numbers[:, 256]]
        self.steps: list[np.ndarray] = []
        self.backs: list[np.ndarray] = []

    def _powers(self, size: int) -> None:
        if self.steps and len(self.steps[0]) >= size:
            return
        room = max(size, CHUNK + (CHUNK >> 3))
        self.steps, self.backs = [], []
        for base in self.bases:
            for held, factor in ((self.steps, base), (self.backs, pow(base, -1, 1 << 64))):
                powers = np.full(room, factor, dtype=np.uint64)
                powers[0] = 1
                held.append(np.multiply.accumulate(powers))

    def words(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
        """A hash per word and lane: the sum of byte values times powers, divided by the first power."""
        self._powers(len(data) + 1)
        found = []
        for values, steps, backs in zip(self.values, self.steps, self.backs):
            sums = np.zeros(len(data) + 1, dtype=np.uint64)
            np.cumsum(values[data] * steps[: len(data)], out=sums[1:])
            found.append(_mixed((sums[ends] - sums[starts]) * backs[starts]))
        return found

    def lang(self, lang: bytes) -> list[np.uint64]:
        data = np.frombuffer(lang + b"\x00", dtype=np.uint8)
        return [w[0] for w in self.words(data, np.array([0]), np.array([len(data)]))]


def _chunks(texts: Iterator[bytes], again: int) -> Iterator[tuple[bytes, int]]:
    """(bytes, number of leading words that were counted before) for texts of any length.

    Short texts are put together, with a line end between them. A text beyond a chunk is
    cut behind a word, and the next chunk begins with the last ``again`` words of the open piece.
    """
    held, size = [], 0
    for text in texts:
        text = text.translate(_LOWER)
        if len(text) > CHUNK:
            yield from _cut(text, again)
            continue
        held.append(text)
        size += len(text) + 1
        if size >= CHUNK:
            yield b"\n".join(held), 0
            held, size = [], 0
    if held:
        yield b"\n".join(held), 0


def _cut(text: bytes, again: int) -> Iterator[tuple[bytes, int]]:
    at, prior = 0, []
    while at < len(text):
        end = at + CHUNK
        if end < len(text):
            stops = [p for p in (text.find(b" ", end), text.find(b"\n", end)) if p >= 0]
            end = min(stops, default=len(text))
        data = b" ".join([*prior, text[at:end]])
        yield data, len(prior)
        prior = data[data.rfind(b"\n") + 1 :].split(b" ")
        prior = [word for word in prior if word][-again:] if again else []
        if text[end : end + 1] == b"\n":
            prior = []
        at = end + 1


def _grams(
    texts: Iterator[bytes], lang: bytes, hasher: _Hasher, longest: int
) -> Iterator[tuple[np.ndarray, list[tuple[int, list[np.ndarray], np.ndarray, np.ndarray]]]]:
    """Of each chunk its bytes, and for each n the lanes, starts and ends of its n-grams."""
    salt = hasher.lang(lang)
    for raw, prior in _chunks(texts, longest - 1):
        while b"  " in raw:
            raw = raw.replace(b"  ", b" ")
        data = np.frombuffer(raw, dtype=np.uint8)
        inside = np.zeros(len(data) + 2, dtype=np.int8)
        inside[1:-1] = (data != 32) & (data != 10)
        edges = np.flatnonzero(np.diff(inside))
        starts, ends = edges[::2], edges[1::2]
        piece = np.searchsorted(np.flatnonzero(data == 10), starts)
        words = hasher.words(data, starts, ends)
        found, lanes = [], words
        for n in range(1, longest + 1):
            if n > 1:
                lanes = [_mixed(lane[:-1] * np.uint64(5) + words[i][n - 1 :]) for i, lane in enumerate(lanes)]
            if len(starts) < n:
                break
            last = np.arange(n - 1, len(starts))
            whole = np.flatnonzero((piece[last] == piece[last - n + 1]) & (last >= prior))
            salted = [_mixed(lane[whole] ^ salt[i]) for i, lane in enumerate(lanes)]
            found.append((n, salted, starts[whole], ends[whole + n - 1]))
        yield data, found


def _by_lang(batch: pa.RecordBatch) -> Iterator[tuple[str, Iterator[bytes]]]:
    """(language, texts) of a batch of ``lang, text``."""
    langs = batch.column(0).dictionary_encode()
    texts = batch.column(1)
    for code, lang in enumerate(langs.dictionary.to_pylist()):
        rows = texts.filter(pc.equal(langs.indices, code))
        yield lang, (bytes(memoryview(t.as_buffer())) for t in rows)


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the sums of their counts."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])[: len(keys)])
    return keys[first], np.add.reduceat(counts[order], first) if len(first) else counts[:0]


def partition_of(keys: np.ndarray, partitions: int) -> np.ndarray:
    """The hash partition of 64-bit hashes, in the order of the hashes."""
    return ((keys >> np.uint64(32)) * np.uint64(partitions)) >> np.uint64(32)


class MisraGries:
    """A mergeable summary of weighted keys: at most ``capacity`` counters.

    ``taken_off`` never exceeds the mass divided by ``capacity + 1``; a key's count is
    too low by that at most, so a key that occurs oftener has a counter.
    """

    def __init__(self, capacity: int):
        self.capacity, self.taken_off = capacity, 0
        self.keys, self.counts = np.empty(0, np.uint64), np.empty(0, np.int64)
        self._held, self._size = [], 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self._held.append((keys, counts))
        self._size += len(keys)
        if self._size >= max(len(self.keys), HELD):
            self.settle()

    def settle(self) -> None:
        """Merge what was added and take the count of the first key beyond the capacity off all."""
        keys = np.concatenate([self.keys, *(k for k, _ in self._held)])
        counts = np.concatenate([self.counts, *(c for _, c in self._held)])
        self._held, self._size = [], 0
        self.keys, self.counts = _summed(keys, counts)
        beyond = len(self.keys) - self.capacity
        if beyond > 0:
            off = np.partition(self.counts, beyond - 1)[beyond - 1]
            kept = self.counts > off
            self.keys, self.counts = self.keys[kept], self.counts[kept] - off
            self.taken_off += int(off)

    def at_least(self, threshold: int) -> np.ndarray:
        """The keys that may occur ``threshold`` times or oftener."""
        self.settle()
        return self.keys[self.counts + self.taken_off >= threshold]


def _packed(counts: np.ndarray) -> bytes:
    """Counts of one, two or eight bytes each, whichever holds the largest."""
    most = int(counts.max())
    return counts.astype(np.uint8 if most < 1 << 8 else np.uint16 if most < 1 << 16 else np.int64).tobytes()


def _unpacked(counts: bytes, size: int) -> np.ndarray:
    return np.frombuffer(counts, {1: np.uint8, 2: np.uint16, 8: np.int64}[len(counts) // size]).astype(np.int64)


SUMMARY = "part int, mass long, keys binary, counts binary"


def _summaries(partitions: int, longest: int):
    """Of each task's texts: rows with counted hashes, and a row with the mass, by hash partition."""

    def rows(keys: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        parts, first = np.unique(partition_of(keys, partitions), return_index=True)
        ends = np.append(first[1:], len(keys))
        short = (keys & np.uint64((1 << KEY_BITS) - 1)).astype(np.uint32)
        yield pa.RecordBatch.from_arrays([
            pa.array(parts.astype(np.int32)), pa.nulls(len(parts), pa.int64()),
            pa.array([short[a:z].tobytes() for a, z in zip(first, ends)], pa.binary()),
            pa.array([_packed(counts[a:z]) for a, z in zip(first, ends)], pa.binary()),
        ], names=["part", "mass", "keys", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, mass = _Hasher(1), np.zeros(partitions, np.int64)
        held, size = [], 0
        for batch in batches:
            for lang, texts in _by_lang(batch):
                for _, found in _grams(texts, lang.encode(), hasher, longest):
                    for _, (keys,), _, _ in found:
                        mass += np.bincount(partition_of(keys, partitions).astype(np.int64), minlength=partitions)
                        held.append(_summed(keys, np.ones(len(keys), np.int64)))
                        size += len(held[-1][0])
                    if size >= HELD:
                        keys, counts = _summed(*(np.concatenate(side) for side in zip(*held)))
                        held, size = [(keys, counts)], len(keys)
                        if size >= HELD >> 1:
                            yield from rows(keys, counts)
                            held, size = [], 0
        if size:
            yield from rows(*_summed(*(np.concatenate(side) for side in zip(*held))))
        parts = np.flatnonzero(mass)
        yield pa.RecordBatch.from_arrays([
            pa.array(parts.astype(np.int32)), pa.array(mass[parts]),
            pa.nulls(len(parts), pa.binary()), pa.nulls(len(parts), pa.binary()),
        ], names=["part", "mass", "keys", "counts"])

    return run


def _survivors(threshold: int, most_bits: int):
    """Of the rows of ``SUMMARY`` in order of partition, masses first: a bit map per hash partition."""

    def bits(summary: MisraGries) -> bytes:
        keys = summary.at_least(threshold)
        size = 64
        while size < 8 * len(keys) and size < most_bits:
            size *= 2
        marks = np.zeros(size, np.uint8)
        marks[(keys & np.uint64(size - 1)).astype(np.int64)] = 1
        return np.packbits(marks, bitorder="little").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, mass, summary = None, 0, None
        for batch in batches:
            for row in batch.to_pylist():
                if row["part"] != current:
                    if summary:
                        yield pa.RecordBatch.from_pydict({"part": pa.array([current], pa.int32()), "bits": [bits(summary)]})
                    current, mass, summary = row["part"], 0, None
                if row["keys"] is None:
                    mass += row["mass"]
                    continue
                summary = summary or MisraGries(mass // threshold + 1)
                keys = np.frombuffer(row["keys"], np.uint32).astype(np.uint64)
                summary.add(keys, _unpacked(row["counts"], len(keys)))
        if summary:
            yield pa.RecordBatch.from_pydict({"part": pa.array([current], pa.int32()), "bits": [bits(summary)]})

    return run


class _BitMaps:
    """The bit maps of all hash partitions, one after another."""

    def __init__(self, maps: dict[int, bytes], partitions: int):
        parts = [maps.get(p, bytes(8)) for p in range(partitions)]
        sizes = np.array([8 * len(p) for p in parts], np.uint64)
        self.partitions, self.masks = partitions, sizes - np.uint64(1)
        self.starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.uint64)
        self.data = np.frombuffer(b"".join(parts), np.uint8)

    def holds(self, keys: np.ndarray) -> np.ndarray:
        part = partition_of(keys, self.partitions).astype(np.int64)
        at = self.starts[part] + (keys & self.masks[part])
        return (self.data[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


COUNTED = "lang string, n int, phrase string, a long"


def _slices(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The texts between starts and ends."""
    sizes = ends - starts
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    places = np.repeat(starts - offsets[:-1], sizes) + np.arange(offsets[-1])
    return pa.Array.from_buffers(
        pa.large_utf8(), len(sizes), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data[places])]
    ).cast(pa.utf8())


def _counts(maps, longest: int):
    """Of each chunk the n-grams that the bit maps hold with their counts, and a row with its number of words (n = 0)."""

    def batch_of(lang: str, n: int, phrases: pa.Array, counts: np.ndarray) -> pa.RecordBatch:
        size = len(phrases)
        return pa.RecordBatch.from_arrays(
            [pa.repeat(lang, size), pa.array(np.full(size, n, np.int32)), phrases, pa.array(counts)],
            names=["lang", "n", "phrase", "a"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, held = _Hasher(2), maps.value
        for batch in batches:
            for lang, texts in _by_lang(batch):
                for data, found in _grams(texts, lang.encode(), hasher, longest):
                    for n, (keys, more), starts, ends in found:
                        if n == 1 and len(keys):
                            yield batch_of(lang, 0, pa.array([""]), np.array([len(keys)]))
                        kept = np.flatnonzero(held.holds(keys))
                        if not len(kept):
                            continue
                        order = kept[np.lexsort((more[kept], keys[kept]))]
                        fresh = (keys[order][1:] != keys[order][:-1]) | (more[order][1:] != more[order][:-1])
                        first = np.flatnonzero(np.concatenate([[True], fresh]))
                        counts = np.diff(np.append(first, len(order)))
                        at = order[first]
                        yield batch_of(lang, n, _slices(data, starts[at], ends[at]), counts)

    return run


def frequent_phrases(
    docs: DataFrame, min_count: int = 10, longest: int = 3, text: str = "text", lang: str = "lang",
    scratch: Scratch | None = None,
) -> DataFrame:
    """``lang, n, phrase, a``: n-grams of 1 to ``longest`` words with their exact counts, from ``min_count`` on.

    The row of a language with ``n`` 0 holds its number of words. Counts are those of ``collocations``.
    Only the bit maps reach the driver and the tasks, ``MOST_BITS`` bits at most.
    """
    scratch = scratch_for(docs, scratch)
    spark = docs.sparkSession
    words = docs.select(
        F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit(UNKNOWN_LANG)).alias("lang"),
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"),
    )
    size = words.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    partitions = max(LEAST_PARTITIONS, -(-size // PARTITION_BYTES))
    summaries = words.mapInArrow(_summaries(partitions, longest), SUMMARY)
    placed = summaries.repartition(partitions, "part").sortWithinPartitions("part", F.col("mass").desc_nulls_last())
    most_bits = 1 << (max(MOST_BITS // partitions, 64).bit_length() - 1)
    survivors = placed.mapInArrow(_survivors(min_count, most_bits), "part int, bits binary")
    maps = spark.sparkContext.broadcast(_BitMaps({r.part: bytes(r.bits) for r in survivors.collect()}, partitions))
    counted = words.mapInArrow(_counts(maps, longest), COUNTED)
    totals = counted.groupBy("lang", "n", "phrase").agg(F.sum("a").alias("a"))
    return scratch.cut(totals.filter((F.col("n") == 0) | (F.col("a") >= min_count)), "phrases")


def collocations(
    docs: DataFrame, min_count: int = 10, longest: int = 3, top: int = 2000, covered: int = 50,
    text: str = "text", lang: str = "lang", scratch: Scratch | None = None,
) -> DataFrame:
    """The best collocations of each language: ``lang, rank, phrase, a, l, r, n, score``.

    Texts are lower-cased (A to Z), split at ``.,;:!?`` and line ends into pieces, and those at
    blanks and tabs into words; a phrase lies within a piece. ``a`` is how often a phrase of two
    words or more occurs, ``l`` and ``r`` how often its two parts do at the cut with the lowest
    score, ``n`` the number of words of its language, and ``score`` is ``floor(1000000 a a / (l r))``.
    A phrase goes if one that contains it has at least ``covered`` percent of its occurrences.
    The ``top`` of a language by score, count and phrase (bytes) are returned.

    Null texts count as empty, a null language as ``und``. Repeated rows count each time. A table
    without words gives an empty result, as does one where nothing occurs ``min_count`` times.
    Other columns are not read, whatever their names.

    All counts are exact: see ``frequent_phrases``. A frequent word is one counter per task and
    hash partition, so it is no hot key there; it is one in the joins that fetch the counts of
    parts, both sides of which are plain tables that adaptive execution can split. A language is
    ranked in parts first, of which each sends on its first ``top`` rows.
    """
    scratch = scratch_for(docs, scratch)
    found = frequent_phrases(docs, min_count, longest, text, lang, scratch)
    counts = found.filter("n > 0").select("lang", F.col("phrase").alias("part"), F.col("a").alias("part_a"))
    phrases = found.filter("n > 1")
    words = F.split("phrase", " ")

    def joined(start, size):
        return F.array_join(F.slice(words, start, size), " ")

    cuts = phrases.select(
        "lang", "phrase", "n", "a", F.explode(F.sequence(F.lit(1), F.col("n") - 1)).alias("k"),
    )
    sides = cuts.select(
        "lang", "phrase", "a", "k",
        F.explode(F.array(
            F.struct(F.lit(True).alias("left"), joined(F.lit(1), F.col("k")).alias("part")),
            F.struct(F.lit(False).alias("left"), joined(F.col("k") + 1, F.col("n") - F.col("k")).alias("part")),
        )).alias("side"),
    ).select("lang", "phrase", "a", "k", "side.left", "side.part")
    parts = sides.join(counts, ["lang", "part"]).groupBy("lang", "phrase", "a", "k").agg(
        F.max(F.when(F.col("left"), F.col("part_a"))).alias("l"),
        F.max(F.when(~F.col("left"), F.col("part_a"))).alias("r"),
    )
    exact = {c: f"CAST({c} AS DECIMAL(19, 0))" for c in "alr"}
    score = F.expr(f"CAST(1000000 * ({exact['a']} * {exact['a']}) AS DECIMAL(38, 0)) div ({exact['l']} * {exact['r']})")
    lowest = parts.withColumn("score", score).groupBy("lang", "phrase", "a").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("best")
    ).select("lang", "phrase", "a", "best.l", "best.r", "best.score")

    none = F.array().cast("array<string>")
    inner = phrases.select("lang", "a", F.explode(F.concat(none, *[
        F.when(
            F.col("n") > size,
            F.transform(F.sequence(F.lit(1), F.greatest("n", F.lit(size)) - size + 1), lambda at: joined(at, size)),
        ).otherwise(none)
        for size in range(2, longest)
    ])).alias("phrase"))
    around = inner.groupBy("lang", "phrase").agg(F.max("a").alias("around"))
    left = lowest.join(around, ["lang", "phrase"], "left").filter(
        F.col("around").isNull() | (F.col("around") * 100 < F.col("a") * covered)
    )
    best = [F.desc("score"), F.desc("a"), "phrase"]
    part = F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))
    near = left.withColumn("_part", part).withColumn(
        "_near", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*best))
    ).filter(F.col("_near") <= top)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*best))
    ranked = near.withColumn("rank", rank).filter(F.col("rank") <= top)
    totals = found.filter("n = 0").select("lang", F.col("a").alias("n"))
    return ranked.join(F.broadcast(totals) if _few(totals) else totals, "lang").select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )


def _few(totals: DataFrame, most: int = 10_000) -> bool:
    """Whether there are so few languages that their totals fit everywhere."""
    return totals.limit(most + 1).count() <= most
