"""Column helpers shared by the operators."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringwatch.session import Scratch

# The six ASCII white-space characters, and a word between them.
SPACE = r"\x20\x09-\x0D"
WORD = rf"[^{SPACE}]+"


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def single_spaced(text: Column) -> Column:
    """Every run of white space as one space; null as empty.

    A lone space already is what it becomes, so the pattern leaves it alone: most
    runs are lone spaces, and a match costs far more than a miss.
    """
    runs = rf"[\x09-\x0D][{SPACE}]*|\x20[{SPACE}]+"
    return F.regexp_replace(F.coalesce(text, F.lit("")), runs, " ")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def utf8_bytes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint")


def dealt(rows: DataFrame, *key: str) -> DataFrame:
    """Few small rows that stand for much work, each a task of its own up to the tasks of a shuffle.

    Adaptive execution would put small rows together, but leaves a given number of tasks alone. The
    rows are counted, so they must be cheap to compute.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    most = max(4 * cores, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return rows.repartition(max(1, min(rows.count(), most)), *key)


def row_keys(docs: DataFrame) -> list[Column]:
    """96 bits of hash over all columns: equal for rows that are equal throughout."""
    values = [
        F.col(f"`{name}`").cast("string") if "map" in kind or kind == "variant" else F.col(f"`{name}`")
        for name, kind in docs.dtypes
    ]
    return [F.xxhash64(*values), F.hash(*values)]


def kept_rows(docs: DataFrame, found: DataFrame, scratch: Scratch) -> DataFrame:
    """The rows of ``docs`` that ``found`` keeps: a row per row with ``_key, _more`` and ``kept``.

    Only keys are written down and compared; the documents are scanned again and lose
    the few keys that go. Of rows that are equal throughout and of which some are kept,
    as many as one stay.
    """
    counts = found.groupBy("_key", "_more").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("kept").alias("stay")
    )
    fewer = scratch.cut(counts.filter("stay < n"), "fewer")
    key, more = (free_name(docs, n) for n in ("_key", "_more"))
    names = [key, more]
    marked = docs.withColumns(dict(zip(names, row_keys(docs))))
    gone = fewer.filter("stay = 0").select("_key", "_more").toDF(*names)
    thinned = fewer.filter("stay > 0").select("_key", "_more").toDF(*names)
    left = marked.join(gone, names, "left_anti")
    if not thinned.isEmpty():
        once = left.join(thinned, names, "left_semi").dropDuplicates(names)
        left = left.join(thinned, names, "left_anti").unionByName(once)
    return left.select(*[F.col(f"`{c}`") for c in docs.columns])


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` clashes with it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
