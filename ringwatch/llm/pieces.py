"""SentencePiece encoding and decoding, with a max-plus scan over giant documents.

An encoding is the best path through a text: nodes are positions, arcs the pieces
between them, and what a piece adds may depend on the piece before it. For a unigram
model an arc adds its piece's score. For a BPE model it adds nothing where the two
pieces are what merging their joint text gives, and minus infinity elsewhere; a
sequence whose neighbours all agree in that way is the one that merging the whole
text gives, so exactly one path is left.

A giant document is cut into chunks at any character. The state at a cut is how far
the piece across it reaches, and for BPE how long that piece is. Each chunk gives
the max-plus matrix from the states at its start to those at its end. Products of
matrices are associative: groups of chunks are multiplied apart from one another,
then the groups of a document are scanned, the best state at every cut is read off
backwards, and every chunk traces its own pieces between its two states.
"""

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringwatch.llm.common import dealt
from ringwatch.session import Scratch, scratch_for

#: Longer texts (in characters) are encoded by chunks.
GIANT = 1 << 16
CHUNK = 1 << 14
#: Chunks whose matrices one task multiplies; groups of a document are scanned by one
#: task, at most 2^31 / (CHUNK * GROUP) of them, as a string holds less than 2^31 bytes.
GROUP = 64
#: Characters encoded, and ids decoded, by one call of the library. Its lists of
#: Python integers take many times the memory of the arrays that are kept.
BATCH_CHARS = 1 << 18
BATCH_IDS = 1 << 17
#: Remembered answers about neighbouring pieces.
MEMORY = 1 << 21

State = tuple[int, int]
#: (state at the start, state at the end) -> best score in between.
Matrix = dict[State, dict[State, float]]


class _Memory(dict):
    """Remembered results of a function of one argument; forgets all when full."""

    def __init__(self, function):
        super().__init__()
        self.function = function

    def __missing__(self, key):
        if len(self) >= MEMORY:
            self.clear()
        self[key] = value = self.function(key)
        return value


class Pieces:
    """The pieces of a model file, and what an arc of the lattice adds."""

    def __init__(self, model_file: str, kind: str = "bpe"):
        if kind not in ("bpe", "unigram"):
            raise ValueError(f"unknown kind of model: {kind}")
        self.processor = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.kind = kind
        p = self.processor
        plain = [
            i for i in range(p.get_piece_size())
            if not (p.is_control(i) or p.is_unknown(i) or p.is_byte(i) or p.is_unused(i))
        ]
        self.score = {p.id_to_piece(i): p.get_score(i) for i in plain}
        self.id = {p.id_to_piece(i): i for i in plain}
        self.longest = max(map(len, self.id), default=1)
        self.unknown_score = min(self.score.values(), default=0.0) - 10.0
        self.bytes = [p.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.has_bytes = p.is_byte(self.bytes[0])
        # Pieces that a path may use besides lone characters: those that merging can give.
        self.usable = {x for x in self.id if kind == "unigram" or len(self.merged(x)) == 1}
        self.prefixes = {x[:n] for x in self.usable for n in range(1, len(x))}
        self.weight = _Memory(self._weight)

    def merged(self, text: str) -> list[str]:
        """BPE of a short text: the best-scored neighbours merge first, the left ones among equals."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.score.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _weight(self, pair: tuple[str, str]) -> float | None:
        """What the arc of a piece adds after another (empty at the start); None for minus infinity."""
        before, token = pair
        if self.kind == "unigram":
            return self.score.get(token, self.unknown_score)
        return 0.0 if not before or self.merged(before + token) == [before, token] else None

    def ids(self, token: str) -> list[int]:
        found = self.id.get(token)
        if found is not None:
            return [found]
        if self.has_bytes:
            return [self.bytes[b] for b in token.encode("utf-8", "replace")]
        return [self.processor.unk_id()]


@lru_cache(maxsize=4)
def load(model_file: str, kind: str = "bpe") -> Pieces:
    return Pieces(model_file, kind)


class Chunk:
    """Characters ``start..end`` of a normalised text, with the context that pieces across its cuts need."""

    def __init__(self, pieces: Pieces, text: str, start: int, end: int):
        self.pieces, self.text, self.start, self.end = pieces, text, start, end

    def entries(self) -> list[State]:
        """States at the start: (characters of the chunk the piece across it covers, its length)."""
        if self.start == 0:
            return [(0, 0)]
        found = []
        for over in range(min(self.pieces.longest, len(self.text) - self.start + 1)):
            for size in range(over + 1, min(self.pieces.longest, self.start + over) + 1):
                at = self.start + over
                if size == 1 or self.text[at - size : at] in self.pieces.usable:
                    found.append((over, size if self.pieces.kind == "bpe" else 0))
        return sorted(set(found))

    def run(self, entry: State, known: tuple[list, list] | None = None):
        """Best score and last piece length at every position that pieces starting in the chunk end at.

        With the lists of an earlier run, stops once as many positions in a row as the
        longest piece has characters agree with it up to a constant: from there on both
        runs are the same. Returns the lists, and the place and the constant.
        """
        pieces, text = self.pieces, self.text
        longest, bpe = pieces.longest, pieces.kind == "bpe"
        last_end = min(len(text), self.end + longest - 1)
        size = last_end - self.start + 1
        score: list[float | None] = [None] * size
        length = [0] * size
        first = self.start + entry[0]
        if first - self.start >= size:
            return score, length, None, 0.0
        score[entry[0]], length[entry[0]] = 0.0, entry[1]
        same, shift = 0, None
        prefixes, usable, weight, start = pieces.prefixes, pieces.usable, pieces.weight, self.start
        for begin in range(first, last_end + 1):
            at = begin - start
            prior = score[at]
            if known and begin > first:
                there = known[0][at]
                if prior is None or there is None:
                    agrees = prior is None and there is None
                else:
                    gap = prior - there
                    agrees = length[at] == known[1][at] and (shift is None or gap == shift)
                    shift = gap if agrees else None
                same = same + 1 if agrees else 0
                if same > longest and shift is not None:
                    return score, length, at, shift
            if prior is None or begin >= self.end:
                continue
            before = text[begin - length[at] : begin] if bpe else ""
            for end in range(begin + 1, min(begin + longest, last_end) + 1):
                token = text[begin:end]
                if token in usable or end == begin + 1:
                    added = weight[before, token]
                    if added is not None:
                        there = score[end - start]
                        if there is None or prior + added > there:
                            score[end - start], length[end - start] = prior + added, end - begin
                if token not in prefixes:
                    break
        return score, length, None, 0.0

    def exits(self, score: list, length: list) -> dict[State, float]:
        """Scores of the states at the end that are reached."""
        bpe = self.pieces.kind == "bpe"
        return {
            (at - (self.end - self.start), length[at] if bpe else 0): value
            for at, value in enumerate(score)
            if value is not None and at >= self.end - self.start
        }

    def matrix(self) -> Matrix:
        found: Matrix = {}
        known, base = None, {}
        for entry in self.entries():
            score, length, met, shift = self.run(entry, known)
            if met is not None:
                reached = {state: value + shift for state, value in base.items()}
            else:
                reached = self.exits(score, length)
                if reached and known is None:
                    known, base = (score, length), reached
            if reached:
                found[entry] = reached
        return found

    def trace(self, entry: State, leave: State) -> list[str]:
        """The pieces between two states, in order."""
        _, length, _, _ = self.run(entry)
        at, stop, tokens = self.end + leave[0], self.start + entry[0], []
        while at > stop:
            n = length[at - self.start]
            tokens.append(self.text[at - n : at])
            at -= n
        return tokens[::-1]


def product(left: Matrix, right: Matrix) -> Matrix:
    """Max-plus product: the best way over any state in between."""
    result: Matrix = {}
    for start, middles in left.items():
        row: dict[State, float] = {}
        for middle, first in middles.items():
            for end, second in right.get(middle, {}).items():
                if end not in row or first + second > row[end]:
                    row[end] = first + second
        if row:
            result[start] = row
    return result


def states_between(matrices: list[Matrix], start: State, end: State | None) -> list[State]:
    """The states of the best path at all cuts, from ``start`` on.

    Scans forwards keeping the best score of each state, then reads the path off
    backwards from ``end``, or from the end of the text.
    """
    scores = [{start: 0.0}]
    for matrix in matrices:
        now = product({start: scores[-1]}, matrix).get(start, {})
        scores.append(now)
    if end is None:
        end = max((state for state in scores[-1] if state[0] == 0), key=lambda s: scores[-1][s])
    path = [end]
    for matrix, before in zip(reversed(matrices), reversed(scores[:-1])):
        ways = [(v + matrix[s][path[-1]], s) for s, v in before.items() if path[-1] in matrix.get(s, {})]
        path.append(max(ways)[1])
    return path[::-1]


def _pack(matrix: Matrix) -> tuple[list[int], list[float]]:
    states, scores = [], []
    for start, row in matrix.items():
        for end, value in row.items():
            states += [*start, *end]
            scores.append(value)
    return states, scores


def _unpack(states, scores) -> Matrix:
    matrix: Matrix = {}
    for (a, b, c, d), value in zip(np.asarray(states).reshape(-1, 4).tolist(), np.asarray(scores).tolist()):
        matrix.setdefault((a, b), {})[c, d] = value
    return matrix


# As Spark jobs


_TOKENS = pa.schema([
    ("doc_id", pa.int64()), ("text", pa.string()), ("token_ids", pa.list_(pa.int32())), ("decoded", pa.string()),
])
TOKENS = "doc_id long, text string, token_ids array<int>, decoded string"


def _spans(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Neighbouring rows that are encoded together."""
    start, total = 0, 0
    for i, size in enumerate(sizes.tolist()):
        total += size
        if total >= BATCH_CHARS:
            yield start, i + 1
            start, total = i + 1, 0
    if start < len(sizes):
        yield start, len(sizes)


def _tokenise(batches: Iterator[pa.RecordBatch], model_file: str, kind: str, back: bool) -> Iterator[pa.RecordBatch]:
    """Ids, and if asked for the text they decode to, of rows ``doc_id, text``.

    Rows go out in small batches, so that a task holds the lists of few texts.
    """
    processor = load(model_file, kind).processor
    for batch in batches:
        texts = batch.column("text").cast(pa.string())
        for start, end in _spans(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)):
            part = texts.slice(start, end - start)
            known = [t for t in part.to_pylist() if t is not None]
            ids = iter(processor.encode(known, num_threads=1) if known else [])
            lists = [next(ids) if valid else None for valid in part.is_valid().to_pylist()]
            found = iter(processor.decode([x for x in lists if x is not None], num_threads=1) if known and back else [])
            decoded = [None if x is None or not back else next(found) for x in lists]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(start, end - start), part,
                    pa.array(lists, pa.list_(pa.int32())), pa.array(decoded, pa.string()),
                ],
                schema=_TOKENS,
            )


def _decode_ids(processor, lists: list[np.ndarray | None]) -> list[str | None]:
    result: list[str | None] = [None] * len(lists)
    group, size = [], 0
    for i, ids in enumerate([*lists, None]):
        if i < len(lists) and ids is not None:
            group.append(i)
            size += len(ids)
        if group and (size >= BATCH_IDS or i == len(lists)):
            found = processor.decode([lists[j].tolist() for j in group], num_threads=1)
            for j, text in zip(group, found):
                result[j] = text
            group, size = [], 0
    return result


def _giant_ids(docs: DataFrame, text: str, id_col: str, model_file: str, kind: str, chunk: int, scratch: Scratch):
    """``_id, text, token_ids`` of the given documents by the scan over their chunks."""
    source = docs.select(
        F.col(id_col).cast("bigint").alias("_id"), F.col(text).alias("_text"),
        F.monotonically_increasing_id().alias("_row"),
    )
    source = scratch.cut(source, "giants")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces = load(model_file, kind)
        for batch in batches:
            for row, whole in zip(batch["_row"], batch["_text"]):
                normal = pieces.processor.normalize(whole)
                side = pieces.longest
                for i, start in enumerate(range(0, max(1, len(normal)), chunk)):
                    end, low = min(len(normal), start + chunk), max(0, start - side)
                    yield pd.DataFrame({
                        "_row": [row], "_chunk": [i], "part": [normal[low : end + side]],
                        "start": [start - low], "end": [end - low],
                    })

    schema = "_row long, _chunk long, part string, start int, end int"
    source = scratch.cut(dealt(source, "_row"), "dealt")
    chunks = dealt(scratch.cut(source.mapInPandas(cut, schema), "chunks"), "_row", "_chunk")

    def weigh(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces = load(model_file, kind)
        for batch in batches:
            packed = [
                _pack(Chunk(pieces, *r).matrix())
                for r in zip(batch["part"], batch["start"].tolist(), batch["end"].tolist())
            ]
            yield batch[["_row", "_chunk"]].assign(
                states=[s for s, _ in packed], scores=[v for _, v in packed]
            )

    matrix = "_row long, _chunk long, states array<int>, scores array<double>"
    matrices = chunks.mapInPandas(weigh, matrix)
    matrices = scratch.cut(matrices.withColumn("_group", F.floor(F.col("_chunk") / GROUP)), "matrices")

    def multiply(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("_chunk")
        whole = None
        for states, scores in zip(rows["states"], rows["scores"]):
            one = _unpack(states, scores)
            whole = one if whole is None else product(whole, one)
        states, scores = _pack(whole)
        return pd.DataFrame({
            "_row": rows["_row"].iloc[:1], "_group": rows["_group"].iloc[:1], "states": [states], "scores": [scores],
        })

    matrices = dealt(matrices, "_row", "_group")
    groups = matrices.groupBy("_row", "_group").applyInPandas(
        multiply, "_row long, _group long, states array<int>, scores array<double>"
    )

    def scan(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("_group")
        path = states_between([_unpack(*m) for m in zip(rows["states"], rows["scores"])], (0, 0), None)
        return pd.DataFrame({
            "_row": rows["_row"], "_group": rows["_group"],
            "enter": [list(s) for s in path[:-1]], "leave": [list(s) for s in path[1:]],
        })

    ends = "enter array<int>, leave array<int>"
    spans = groups.groupBy("_row").applyInPandas(scan, f"_row long, _group long, {ends}")

    def settle(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("_chunk")
        path = states_between(
            [_unpack(*m) for m in zip(rows["states"], rows["scores"])],
            tuple(rows["enter"].iloc[0]), tuple(rows["leave"].iloc[0]),
        )
        return pd.DataFrame({
            "_row": rows["_row"], "_chunk": rows["_chunk"],
            "enter": [list(s) for s in path[:-1]], "leave": [list(s) for s in path[1:]],
        })

    placed = matrices.join(spans, ["_row", "_group"]).groupBy("_row", "_group").applyInPandas(
        settle, f"_row long, _chunk long, {ends}"
    )

    def trace(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces = load(model_file, kind)
        for batch in batches:
            found = []
            for part, start, end, enter, leave in zip(
                batch["part"], batch["start"].tolist(), batch["end"].tolist(), batch["enter"], batch["leave"]
            ):
                tokens = Chunk(pieces, part, start, end).trace(tuple(enter.tolist()), tuple(leave.tolist()))
                found.append([i for token in tokens for i in pieces.ids(token)])
            yield batch[["_row", "_chunk"]].assign(ids=found)

    placed = scratch.cut(placed, "placed")
    entered = dealt(chunks.join(placed, ["_row", "_chunk"]), "_row", "_chunk")
    traced = entered.mapInPandas(trace, "_row long, _chunk long, ids array<int>")
    in_order = F.array_sort(F.collect_list(F.struct("_chunk", "ids")))
    joined = traced.groupBy("_row").agg(F.flatten(F.transform(in_order, lambda c: c["ids"])).alias("token_ids"))
    return source.join(joined, "_row").select("_id", "_text", "token_ids")


def encode(
    docs: DataFrame,
    model_file: str,
    text: str = "text",
    id_col: str = "doc_id",
    kind: str = "bpe",
    giant: int = GIANT,
    chunk: int = CHUNK,
    back: bool = False,
    scratch: Scratch | None = None,
) -> DataFrame:
    """``doc_id, text, token_ids, decoded`` per row of ``docs``, the ids as the library gives them.

    With ``back`` the ids are decoded again in the same pass; ``decoded`` is null without.

    ``model_file`` must be readable under that path on every executor; ``kind`` says
    what it holds, ``bpe`` or ``unigram``. Texts of up to ``giant`` characters are
    encoded whole by the library, longer ones by the scan over chunks of ``chunk``
    characters. A null text has null ids, an empty one none. Repeated rows and ids
    are rows of their own, other columns are ignored, an empty table gives an empty
    result.
    """
    scratch = scratch_for(docs, scratch)

    long_ = F.coalesce(F.length(text) > giant, F.lit(False))
    usual = docs.filter(~long_).select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    usual = usual.mapInArrow(lambda b: _tokenise(b, model_file, kind, back), TOKENS)
    giants = docs.filter(long_)
    if giants.isEmpty():
        return usual
    found = scratch.cut(_giant_ids(giants, text, id_col, model_file, kind, chunk, scratch), "encoded")
    decoded = decode(F.col("token_ids"), model_file) if back else F.lit(None).cast("string")
    return usual.unionByName(found.toDF("doc_id", "text", "token_ids").withColumn("decoded", decoded))


def decode(token_ids: Column, model_file: str) -> Column:
    """The text of each list of ids; null for null, empty for none."""

    @F.pandas_udf("string")
    def texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        processor = load(model_file).processor
        for batch in batches:
            yield pd.Series(_decode_ids(processor, batch.tolist()), index=batch.index, dtype=object)

    return texts(token_ids)
