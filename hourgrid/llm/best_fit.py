"""Bounded-space online best-fit packing.

Pieces arrive in a random, stored order and go, one after the other, into the open
bin that they fill best.  A fixed number of bins is open: a bitset keyed by free
space tells in a few word operations the least free space that is enough, and
where no bin fits and none may be opened, the fullest one closes.  A packing task
holds its open bins and a bounded look-ahead, however many pieces it sees.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise, read_table
from .packing import cut_pieces

SEQUENCE = 2048
END_ID = 0
OPEN_BINS = 4096  # bins that a task keeps open
LOOK_AHEAD = 4096  # pieces that a task takes at a time, the longest first
GROUP_PIECES = 1 << 16  # pieces of a packing task, on average


class OpenBins:
    """At most ``most`` open bins of one capacity, kept by their free space.

    Bit f of ``mask`` is set while some open bin has f free places.  Bins without
    free places are closed, as are those that give way to a new bin."""

    def __init__(self, capacity: int, most: int):
        if capacity < 1 or most < 1:
            raise ValueError("capacity and the number of open bins must be positive")
        self.capacity, self.most = capacity, most
        self.mask = 0
        self.by_free: list[list[int]] = [[] for _ in range(capacity)]
        self.open = self.made = 0

    def _take(self, free: int) -> int:
        self.open -= 1
        bins = self.by_free[free]
        taken = bins.pop()
        if not bins:
            self.mask ^= 1 << free
        return taken

    def put(self, need: int) -> tuple[int, int]:
        """The bin of a piece and its place there."""
        if not 0 < need <= self.capacity:
            raise ValueError(f"a piece of {need} does not fit a bin of {self.capacity}")
        fitting = self.mask >> need
        if fitting:
            free = need + (fitting & -fitting).bit_length() - 1
            chosen = self._take(free)
        else:
            free, chosen = self.capacity, self.made
            self.made += 1
            if need < free and self.open == self.most:
                self._take((self.mask & -self.mask).bit_length() - 1)  # the fullest closes
        left = free - need
        if left:
            self.by_free[left].append(chosen)
            self.mask |= 1 << left
            self.open += 1
        return chosen, self.capacity - free


def _placed(rows: pa.Table, bins: OpenBins, first_id: int) -> pa.RecordBatch:
    lengths = rows["length"].to_numpy()
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for i in np.argsort(-lengths, kind="stable").tolist():
        sequence[i], offset[i] = bins.put(int(lengths[i]))
    columns = [c for c in rows.column_names if c not in ("slot", "packer")]
    arrays = [rows[c].combine_chunks() for c in columns]
    return pa.RecordBatch.from_arrays([*arrays, pa.array(first_id + sequence), pa.array(offset)], [*columns, "sequence_id", "offset"])


def best_fit(pieces: DataFrame, sequence: int = SEQUENCE, open_bins: int = OPEN_BINS, look_ahead: int = LOOK_AHEAD,
             group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Adds sequence_id and offset to a stored table of pieces (slot, length, ...),
    whose slots are random and are dropped.

    A piece's slot names its packer and its turn there, so packers are even whatever
    the pieces share, and a task that runs again packs alike."""
    packers = max(1, -(-pieces.count() // group_pieces))
    dealt = pieces.withColumn("packer", F.pmod("slot", F.lit(packers)).cast("int")).repartitionById(packers, "packer")
    ordered = dealt.sortWithinPartitions("slot", "length")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = OpenBins(sequence, open_bins)
        first_id = TaskContext.get().partitionId() << 32
        waiting = None
        for batch in batches:
            arrived = pa.Table.from_batches([batch])
            waiting = pa.concat_tables([waiting, arrived]) if waiting is not None else arrived
            while waiting.num_rows >= look_ahead:
                yield _placed(waiting.slice(0, look_ahead), bins, first_id)
                waiting = waiting.slice(look_ahead)
        if waiting is not None and waiting.num_rows:
            yield _placed(waiting, bins, first_id)

    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema if f.name != "slot"]
    return ordered.mapInArrow(pack, ", ".join([*kept, "sequence_id long", "offset long"]))


def best_fit_documents(docs: DataFrame, tokenizer_path: str | None = None, sequence: int = SEQUENCE, open_bins: int = OPEN_BINS,
                       with_ids: bool = True, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Packs documents: one row per piece with doc_id, piece, start, length,
    ids_crc32, sequence_id, offset and (``with_ids``) the piece's token ids.

    Only documents of more than ``sequence`` tokens are cut.  Null and empty texts
    are the single end id; repeated rows are packed once each, also under a null
    doc_id; texts of any length are cut into full sequences and one remainder;
    pieces of one length are taken in the order of their slots; an empty table
    gives no pieces.  The slots are stored before packing."""
    pieces = materialise(cut_pieces(docs, tokenizer_path, sequence, END_ID, with_ids, id_col, text_col), "pieces")
    packed = best_fit(pieces, sequence, open_bins)
    columns = ["start", "length", "ids_crc32", "sequence_id", "offset", *(["ids"] if with_ids else [])]
    return packed.select("doc_id", F.expr(f"int(start div {sequence})").alias("piece"), *columns)


def op11_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_documents(read_table(spark, sf_dir, "documents"), with_ids=False)
