"""Pack documents into as few sequences of a fixed length as possible.

Documents longer than a sequence are cut into full pieces and a rest; full pieces are sequences of their own. How
the rests are combined depends only on how many there are of each length, a table of at most `capacity` rows
whatever the input has. The plan is made on that table: combinations that fill a sequence exactly are found by
looking up the complement of a length among single lengths, sums of pairs, and pairs beside a third, and each is consumed
as often as the counts allow. What is left over is placed best fit, longest first.

The plan says which numbers of which length go to which sequences. Rows get their number within their length in
parallel, from counts per slice of the table, and find their place by a lookup on (length, range of numbers).
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from opinara.llm.common import batches, slices, stored, texts_of
from opinara.llm.token_ids import CHUNKS, chunk_ids

#: A use of the plan: `times` sequences, each holding one piece of every length in `lengths`.
Use = tuple[int, tuple[int, ...]]


def exact_fills(counts: dict[int, int], capacity: int) -> list[Use]:
    """Consume combinations of two, three and four lengths that sum to `capacity`, under the counts.

    The longest length looks for its complement: a single length, then a pair, then a triple: a length of a loop over
    all and a pair. The pair sums are indexed once over the lengths there were; entries whose counts are used up are
    taken out, those that cannot be used now are stepped over.
    """
    uses: list[Use] = []
    left = dict(counts)

    def take(parts: tuple[int, ...]) -> bool:
        need = {p: parts.count(p) for p in parts}
        times = min(left.get(p, 0) // k for p, k in need.items())
        if times > 0:
            uses.append((times, parts))
            for p, k in need.items():
                left[p] -= k * times
        return times > 0

    lengths = sorted(left, reverse=True)
    for a in lengths:
        if 2 * a >= capacity:
            take((a, capacity - a))
    pairs: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]
    alive = [x for x in lengths if left[x] > 0]
    for i, a in enumerate(alive):
        for b in alive[i:]:
            if a + b < capacity:
                pairs[a + b].append((a, b))

    def fill(first: tuple[int, ...], gap: int) -> bool:
        """Use pairs that fill the gap beside `first` until it or they are used up."""
        if gap < 2:
            return False
        got, at = False, len(pairs[gap]) - 1
        while at >= 0 and all(left[x] > 0 for x in first):
            a, b = pairs[gap][at]
            if left[a] <= 0 or left[b] <= 0:
                del pairs[gap][at]
                at -= 1
            elif take((*first, a, b)):
                got = True
            else:  # needs two of a length of which one is left; another pair of the same sum may do
                at -= 1
        return got

    for a in alive:
        while left[a] > 0 and fill((a,), capacity - a):
            pass
        if left[a] > 0:
            for b in alive:
                if left[a] <= 0:
                    break
                if left[b] > 0 and b <= capacity - a - 2:
                    fill((a, b), capacity - a - b)
    return uses


def best_fit(counts: dict[int, int], capacity: int) -> list[Use]:
    """Place what is left, longest first, each into the fullest open sequence that takes it; equal ones together."""
    open_at: dict[int, list[list]] = {}  # room -> [times, lengths]
    rooms: list[int] = []
    done: list[Use] = []

    def put(room: int, times: int, lengths: tuple[int, ...]) -> None:
        if not room:
            done.append((times, lengths))
            return
        if room not in open_at:
            open_at[room] = []
            bisect.insort(rooms, room)
        open_at[room].append([times, lengths])

    for length in sorted(counts, reverse=True):
        n = counts[length]
        while n:
            at = bisect.bisect_left(rooms, length)
            if at == len(rooms):
                each = capacity // length  # new sequences take as many of this length as fit
                if n >= each:
                    put(capacity - each * length, n // each, (length,) * each)
                if n % each:
                    put(capacity - n % each * length, 1, (length,) * (n % each))
                break
            room = rooms[at]
            times, lengths = open_at[room].pop()
            if not open_at[room]:
                del open_at[room]
                rooms.pop(at)
            each = min(room // length, n)
            used = min(times, n // each)
            if used < times:
                put(room, times - used, lengths)
            put(room - each * length, used, (*lengths, *(length,) * each))
            n -= each * used
    return done + [(t, lengths) for held in open_at.values() for t, lengths in held]


def plan(counts: dict[int, int], capacity: int) -> list[Use]:
    """Sequences for pieces of these lengths (all under `capacity`)."""
    uses = exact_fills(counts, capacity)
    left = dict(counts)
    for times, lengths in uses:
        for x in lengths:
            left[x] -= times
    return uses + best_fit({k: v for k, v in left.items() if v}, capacity)


def slots(uses: list[Use]) -> list[tuple[int, int, int, int, int]]:
    """The plan as rows (length, from, to, sequence, offset): pieces numbered from..to-1 of a length go to the
    sequences from `sequence` on, one to each, at `offset`."""
    out, used, sequence = [], {}, 0
    for times, lengths in uses:
        offset = 0
        for x in lengths:
            at = used.get(x, 0)
            out.append((x, at, at + times, sequence, offset))
            used[x] = at + times
            offset += x
        sequence += times
    return out


def pieces(docs: DataFrame, vocabulary: str, capacity: int, end_id: int, memo: int = CHUNKS) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece: the token ids of the text, then `end_id`.

    memo: so many chunks a generation a worker keeps the ids of; fewer take less memory and more time.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                        ("ids_crc32", pa.int64())])

    def cut(parts):
        ids_of = chunk_ids(vocabulary, memo)

        def rows() -> Iterator[dict]:
            for batch in slices(parts, encodes=True):
                texts = batch["text"].to_pylist()
                for doc_id, ids in zip(batch["doc_id"].to_pylist(), ids_of.encode(texts)):
                    ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                    for k, at in enumerate(range(0, len(ids), capacity)):
                        piece = ids[at:at + capacity]
                        yield {"doc_id": doc_id, "piece": k, "start": at, "length": len(piece),
                               "ids_crc32": zlib.crc32(piece.tobytes())}
        yield from batches(rows(), schema)

    return texts_of(docs).mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


def pack(docs: DataFrame, vocabulary: str, capacity: int = 4096, end_id: int = 1, memo: int = CHUNKS) -> DataFrame:
    """Every piece with its place: the columns of `pieces`, sequence_id and offset. memo: as in `pieces`.

    docs: doc_id, text; other columns are ignored. A null or empty text is the piece [end_id]. Repeated rows are
    packed as often as they occur. A null doc_id is packed like others. An empty table gives no piece.
    """
    spark = docs.sparkSession
    cut = stored(pieces(docs, vocabulary, capacity, end_id, memo).withColumn("slice", F.spark_partition_id())
                 .withColumn("at", F.monotonically_increasing_id()))
    full = cut.where(F.col("length") == capacity)
    rest = cut.where(F.col("length") < capacity)
    counts = {r.length: r.n for r in rest.groupBy("length").agg(F.count("*").alias("n")).collect()}
    uses = slots(plan(counts, capacity))
    first_full = max((s + t - f for _, f, t, s, _ in uses), default=0)

    placed = _placed(spark, _numbered(rest, "length"), uses)
    whole = _numbered(full.withColumn("one", F.lit(0)), "one").select(
        *cut.columns, (F.col("number") + first_full).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    return placed.select(columns).union(whole.select(columns))


def _numbered(rows: DataFrame, key: str) -> DataFrame:
    """Number the rows of each key from 0. A slice numbers its own rows; counts per slice give where it begins."""
    sizes = rows.groupBy(key, "slice").agg(F.count("*").alias("n"))
    begins = sizes.select(key, "slice", (F.sum("n").over(Window.partitionBy(key).orderBy("slice")) - F.col("n"))
                          .alias("begin"))
    own = Window.partitionBy(key, "slice").orderBy("at")
    return (rows.withColumn("own", F.row_number().over(own) - 1).join(begins, [key, "slice"])
            .withColumn("number", F.col("begin") + F.col("own")).drop("own", "begin"))


def _placed(spark: SparkSession, rest: DataFrame, uses: list) -> DataFrame:
    """Look up each numbered piece in the plan (as ranges of numbers per length, sorted)."""
    held: dict[int, list] = {}
    for use in sorted(uses):
        held.setdefault(use[0], []).append(use[1:])
    table = spark.sparkContext.broadcast({k: np.array(v, np.int64) for k, v in held.items()})

    def place(parts):
        for batch in parts:
            length, number = (batch[c].to_numpy().astype(np.int64) for c in ("length", "number"))
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for x in np.unique(length):
                at, ranges = np.flatnonzero(length == x), table.value[int(x)]
                row = ranges[np.searchsorted(ranges[:, 0], number[at], side="right") - 1]
                sequence[at] = row[:, 2] + number[at] - row[:, 0]
                offset[at] = row[:, 3]
            yield pa.RecordBatch.from_arrays(
                [*(batch[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32")), pa.array(sequence), pa.array(offset)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return rest.select("doc_id", "piece", "start", "length", "ids_crc32", "number").mapInArrow(
        place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
