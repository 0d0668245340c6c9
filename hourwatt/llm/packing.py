"""Best-fit packing with certificates: token sequences of fixed room, filled as fully as can be.

Texts become ids plus an end id; a text longer than the room is cut into full pieces, the first of
which may be shorter. Pieces are dealt into groups of bounded size. Each group is packed by best-fit
decreasing, and dual feasible functions give a lower bound on the sequences that any packing of the
group needs: where the two agree the group is certified and settled, but for sequences that are far from full. Groups
with a gap exchange pieces: theirs, and those of the settled groups' poor sequences, are dealt anew over half as many
groups and packed again, which is kept while it saves sequences.

A null text is one end id. A null ``doc_id`` stays null. Repeated rows are texts of their own, and
every row is told apart by its place in the table, so a group of copies is dealt over all groups. An empty table
gives an empty result. Other columns of the table play no part, whatever their names. Very long texts are encoded
whole. Ids of special tokens that a text spells out are those the library gives.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourwatt.llm.bpe import vocabulary_path
from hourwatt.llm.bytebpe import encoded
from hourwatt.llm.common import Scratch, split_even

ROOM, END, VOCABULARY = 1024, 2, "byte_bpe_50k.json"
PER_GROUP = 32_768  # pieces of one group at first
MOST = 262_144  # pieces of one group after exchanges: a task holds one group at a time
ROUNDS = 8
POOR = 8  # a sequence with more than an eighth of its room left is exchanged, certified or not
TEXTS = 4096  # encoded at once
STEPS = 40  # dual feasible functions of rounding kind: k from 1 to this

PIECES = "row long, doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = f"{PIECES}, round int, grp long, bin long, offset long, room_left long, bins long, bound long"


def pieces(docs: DataFrame, text: str = "text", room: int = ROOM, path: str | None = None) -> DataFrame:
    """(row, doc_id, piece, start, length, ids_crc32) of every text."""
    path = path or vocabulary_path(VOCABULARY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for at in range(0, big.num_rows, TEXTS):
                batch = big.slice(at, TEXTS)
                whose, piece, start, length, crc = [], [], [], [], []
                for i, ids in enumerate(encoded(path, batch.column("text"))):
                    ids = np.append(ids, np.uint32(END)).astype("<u4")
                    cut = [0, *range((len(ids) - 1) % room + 1, len(ids) + 1, room)]
                    for k, (a, b) in enumerate(zip(cut[:-1], cut[1:])):
                        whose.append(i)
                        piece.append(k)
                        start.append(a)
                        length.append(b - a)
                        crc.append(zlib.crc32(ids[a:b].tobytes()))
                whose = pa.array(whose, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("row").take(whose), batch.column("doc_id").take(whose), pa.array(piece, pa.int32()),
                        pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
                    ],
                    ["row", "doc_id", "piece", "start", "length", "ids_crc32"],
                )

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), F.col(text).alias("text"))
    return rows.mapInArrow(run, PIECES)


def best_fit(sizes: np.ndarray, room: int = ROOM) -> tuple[np.ndarray, np.ndarray, int]:
    """Bin and offset of each size, and the number of bins. ``sizes`` must fall."""
    open_bins: list[list[int]] = [[] for _ in range(room + 1)]  # by room left
    some, made = 0, 0  # bit r: a bin has exactly r left
    bins, offsets = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    for i, size in enumerate(sizes.tolist()):
        fits = some >> size
        if fits:
            left = size + (fits & -fits).bit_length() - 1
            at = open_bins[left].pop()
            if not open_bins[left]:
                some ^= 1 << left
        else:
            left, at, made = room, made, made + 1
        bins[i], offsets[i] = at, room - left
        left -= size
        if left:
            open_bins[left].append(at)
            some |= 1 << left
    return bins, offsets, made


def least_bins(sizes: np.ndarray, room: int = ROOM, steps: int = STEPS) -> int:
    """A number of bins that no packing can go below.

    Functions on sizes under which every full bin still sums to at most one: sizes above ``room - e``
    count as whole bins and those below ``e`` as nothing, for every ``e``; on top, for every k, a size is rounded down
    to a k-th unless (k + 1) times the size is a whole number of bins. All in whole numbers.
    """
    if not len(sizes):
        return 0
    count = np.bincount(sizes, minlength=room + 1)
    size = np.arange(room + 1)
    small = np.arange(room // 2 + 1)  # e
    large = count.sum() - np.cumsum(count)[room - small]  # sizes above room - e
    best = 0
    for k in range(steps + 1):
        if k:
            whole = (k + 1) * size % room == 0
            value, unit = np.where(whole, size * k, (k + 1) * size // room * room), room * k
        else:
            value, unit = size, room
        upto = np.concatenate([[0], np.cumsum(count * value)])
        total = large * unit + upto[room - small + 1] - upto[small]
        best = max(best, int((-(-total // unit)).max()))
    return best


def packed_groups(rows: DataFrame, groups: int, number: int, room: int) -> DataFrame:
    """Pieces dealt into ``groups`` groups and packed there; ``bins`` and ``bound`` are those of the group."""

    def pack(table: pa.Table) -> pa.Table:
        length, row, piece = (table.column(c).to_numpy() for c in ("length", "row", "piece"))
        order = np.lexsort((piece, row, -length))
        table, n = table.take(pa.array(order)), len(order)
        bins, offsets, made = best_fit(length[order], room)
        bound = least_bins(length, room)
        left = room - np.bincount(bins, weights=length[order], minlength=1).astype(np.int64)
        for name, values in (
            ("bin", bins), ("offset", offsets), ("room_left", left[bins]), ("bins", np.full(n, made)), ("bound", np.full(n, bound)),
        ):
            table = table.append_column(name, pa.array(values, pa.int64()))
        return table.select([c.split()[0] for c in PACKED.split(", ")])

    names = [c.split()[0] for c in PIECES.split(", ")]
    dealt = rows.select(
        *names, F.lit(number).alias("round"),
        F.pmod(F.xxhash64("row", "piece", F.lit(number)), F.lit(groups)).alias("grp"),
    )
    return split_even(dealt, "grp").groupBy("grp").applyInArrow(pack, PACKED)


def packing(
    docs: DataFrame, text: str = "text", room: int = ROOM, per_group: int = PER_GROUP, most: int = MOST,
    rounds: int = ROUNDS, path: str | None = None,
) -> DataFrame:
    """Every piece with its sequence and its place there.

    ``certified`` says that the sequences of the piece's group are as few as any packing of the group needs.
    """
    scratch = Scratch(docs.sparkSession, "packing")
    cut = scratch.keep(pieces(docs, text, room, path))
    now = scratch.keep(packed_groups(cut, -(-cut.count() // per_group) or 1, 0, room))
    settled, exchanged = [], (F.col("bins") > F.col("bound")) | (F.col("room_left") > room // POOR)
    for number in range(1, rounds + 1):
        pool = now.where(exchanged)
        open_groups, n, bins = pool.agg(F.countDistinct("grp"), F.count(F.lit(1)), F.countDistinct("grp", "bin")).first()
        groups = max(open_groups // 2, -(-n // most))
        if not 0 < groups < open_groups:
            break
        again = scratch.keep(packed_groups(pool, groups, number, room))
        if again.agg(F.countDistinct("grp", "bin")).first()[0] >= bins:
            break
        settled.append(now.where(~exchanged))
        now = again
    for part in settled:
        now = now.unionByName(part)
    # Rounds, groups and bins have their own digits in the number of a sequence.
    sequence = F.shiftleft(F.col("round").cast("long"), 58) + F.shiftleft("grp", 20) + F.col("bin")
    result = now.select(
        "doc_id", "piece", "start", "length", "ids_crc32", sequence.alias("sequence_id"), "offset",
        (F.col("bins") <= F.col("bound")).alias("certified"),
    )
    return scratch.close(result, "packing-result")
