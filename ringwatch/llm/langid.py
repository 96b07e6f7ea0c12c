"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringwatch.llm.common import free_name

BUCKETS = 1 << 16
#: Labelled rows per language that the model is fitted on, in expectation.
TRAIN_ROWS = 1500
#: Characters scored in one numpy step; longer texts go through it in slices.
SLICE = 1 << 18
STEP = 1 << 20
UNKNOWN = "und"


@dataclass(frozen=True)
class Model:
    """``log_prob[bucket, language]`` and the log priors."""

    languages: list[str]
    log_prob: np.ndarray
    prior: np.ndarray


@lru_cache(maxsize=1)
def _fold() -> np.ndarray:
    """Code point -> its lower-case letter, or a space if it is no letter."""
    table = np.full(0x10000, 32, dtype=np.uint64)
    for code in range(0x10000):
        letter = chr(code)
        if letter.isalpha():
            table[code] = ord(letter.lower()[0])
    return table


def _points(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32)
    low = points < 0x10000
    return np.where(low, _fold()[np.where(low, points, 0)], points).astype(np.uint64)


def _slices(texts: list[str]) -> Iterator[list[tuple[int, str]]]:
    """Groups of (text number, slice); a slice opens with the two characters before it."""
    group, size = [], 0
    for number, text in enumerate(texts):
        for at in range(0, len(text), SLICE):
            piece = (text[at - 2 : at] if at else "  ") + text[at : at + SLICE]
            group.append((number, piece))
            size += len(piece)
            if size >= STEP:
                yield group
                group, size = [], 0
    if group:
        yield group


def _grams(pieces: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of the 2- and 3-grams that end at each character after a piece's first two.

    Returned with the offset of each piece and its length in grams of one kind.
    """
    points = _points("".join(pieces))
    sizes = np.array([len(p) for p in pieces])
    one, two, three = points[2:], points[1:-1], points[:-2]
    pair = one * np.uint64(0x9E3779B1) + two * np.uint64(0x85EBCA77)
    pair ^= pair >> np.uint64(29)
    triple = pair * np.uint64(0xC2B2AE3D) + three * np.uint64(0x27D4EB2F) + np.uint64(1)
    triple ^= triple >> np.uint64(31)
    mask = np.uint64(BUCKETS - 1)
    ends = np.cumsum(sizes)
    inner = np.ones(len(points), dtype=bool)
    inner[ends - sizes] = False
    inner[ends - sizes + 1] = False
    inner = inner[2:]
    pair, triple = (pair & mask)[inner].astype(np.int64), (triple & mask)[inner].astype(np.int64)
    lengths = sizes - 2
    return pair, triple, np.cumsum(lengths) - lengths


def log_likelihoods(texts: list[str], log_prob: np.ndarray) -> np.ndarray:
    """Summed log-probabilities per text and language."""
    total = np.zeros((len(texts), log_prob.shape[1]))
    for group in _slices(texts):
        pair, triple, starts = _grams([piece for _, piece in group])
        for language in range(log_prob.shape[1]):
            column = log_prob[:, language]
            sums = np.add.reduceat(column[pair] + column[triple], starts, dtype=np.float64)
            np.add.at(total[:, language], [number for number, _ in group], sums)
    return total


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Bucket counts per language over the rows of a task."""
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        for language, texts in batch.groupby("_lang")["_text"]:
            mine = counts.setdefault(language, np.zeros(BUCKETS, dtype=np.int64))
            for group in _slices([t for t in texts if t]):
                pair, triple, _ = _grams([piece for _, piece in group])
                mine += np.bincount(pair, minlength=BUCKETS) + np.bincount(triple, minlength=BUCKETS)
    for language, mine in counts.items():
        used = np.flatnonzero(mine)
        yield pd.DataFrame({"language": language, "bucket": used, "n": mine[used]})


def train(
    docs: DataFrame,
    learn_from: Column,
    text: str = "text",
    lang: str = "lang",
    id_col: str = "doc_id",
    rows: int = TRAIN_ROWS,
) -> Model | None:
    """Fit on a sample of the labelled rows; None when no labelled text holds a letter.

    The sample is drawn per language by a hash of the id, about ``rows`` of each or
    all it has. What comes to the driver is one count per language and bucket. The
    languages are the values of ``lang``, taken as they are; there must be few of
    them, as each is a column of the broadcast matrix.
    """
    known = F.col(lang).isNotNull() & F.col(text).isNotNull() & F.coalesce(learn_from, F.lit(False))
    labelled = docs.filter(known)
    sizes = {r[0]: r[1] for r in labelled.groupBy(F.col(lang)).count().toLocalIterator()}
    if not sizes:
        return None
    draw = F.pmod(F.xxhash64(id_col, F.lit("train")), F.lit(1 << 30)) / (1 << 30)
    rates = F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, min(1.0, rows / n))])
    sample = labelled.filter(draw < F.element_at(rates, F.col(lang))).select(
        F.col(lang).alias("_lang"), F.col(text).alias("_text")
    )
    counted = sample.mapInPandas(_count, "language string, bucket long, n long")
    counted = counted.groupBy("language", "bucket").agg(F.sum("n").alias("n")).toPandas()
    if counted.empty:
        return None
    languages = sorted(sizes)
    counts = np.ones((BUCKETS, len(languages)))
    place = {language: i for i, language in enumerate(languages)}
    counts[counted["bucket"], counted["language"].map(place)] += counted["n"]
    log_prob = np.log(counts / counts.sum(axis=0)).astype(np.float32)
    prior = np.log(np.array([sizes[x] for x in languages]) / sum(sizes.values()))
    return Model(languages, np.asfortranarray(log_prob), prior)


def predict(spark, model: Model | None, text: Column) -> Column:
    """Struct of ``lang`` and ``score``, the posterior probability, from the whole text.

    A null text, one without a letter, and every text without a model is ``und``
    with score 0. Equally likely languages go to the first by name.
    """
    schema = "lang string, score double"
    none = F.struct(F.lit(UNKNOWN).alias("lang"), F.lit(0.0).alias("score"))
    if model is None:
        return none
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf(schema)
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = shared.value
        for texts in batches:
            total = log_likelihoods([t or "" for t in texts], model.log_prob) + model.prior
            total -= total.max(axis=1, keepdims=True) if len(total) else 0
            chance = np.exp(total)
            best = chance.argmax(axis=1)
            score = chance.max(axis=1) / chance.sum(axis=1)
            yield pd.DataFrame({"lang": np.array(model.languages, dtype=object)[best], "score": score})

    # The test for letters stays in the JVM; its texts go to Python all the same, as
    # Spark evaluates Python functions ahead of a condition.
    return F.when(F.coalesce(text.rlike(r"\p{L}"), F.lit(False)), scored(text)).otherwise(none)


def is_held_out(id_col: str = "doc_id") -> Column:
    """The rows kept from training: crc32 of the id as text, modulo 4, is 2; a null id is not."""
    remainder = F.crc32(F.col(id_col).cast("string").cast("binary")) % 4
    return F.coalesce(remainder == 2, F.lit(False))


def language_column(docs: DataFrame) -> str:
    return free_name(docs, "_language")


def identify(
    docs: DataFrame, text: str = "text", lang: str = "lang", id_col: str = "doc_id", rows: int = TRAIN_ROWS
) -> DataFrame:
    """``docs`` with a column ``_language`` (struct of ``lang``, ``score``) added at the end.

    Trained on the labelled rows that are not held out; ``lang`` and the id are no
    input of a prediction. ``language_column`` gives the new column's name, which is
    longer by underscores if ``docs`` has one of that name.
    An empty table gives an empty result. The texts' other columns stay in the JVM.
    """
    model = train(docs, ~is_held_out(id_col) & F.col(id_col).isNotNull(), text, lang, id_col, rows)
    return docs.withColumn(language_column(docs), predict(docs.sparkSession, model, F.col(text)))
