"""Packing of tokenized documents into fixed-length sequences.

Documents are cut at multiples of the sequence length, so full pieces fill a
sequence each, and the remainders are packed by first-fit decreasing inside
randomised groups.  A tournament tree over the bin capacities finds the first
bin that fits in O(log bins).
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise, read_table
from .tokens import slices

SEQUENCE = 2048
END_ID = 1
GROUP_PIECES = 20_000  # pieces of a packing group, on average
CACHED_WORDS = 1_000_000  # words whose ids a worker keeps

def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


#: Fixed values of the word tokenizer: how it cuts a lower-cased word into pieces
#: (here for ASCII and the Latin-1 letters), and its letter for every byte.
_PIECE = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\\sa-z0-9ß-öø-ÿ]+")
_PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]+")


def byte_letters() -> dict[int, str]:
    """Printable bytes stand for themselves, the others follow from U+0100."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(0x100 + n) for n, b in enumerate(hidden)}


class WordIds(dict):
    """Ids (little-endian unsigned 32-bit) of a word, encoded when first met.

    The tokenizer drops white space and never joins tokens across it, so the ids
    of a text are those of its words in turn.  Texts are cut at spaces and line
    feeds only; a word with anything but ASCII and Latin-1 letters, or with the
    start of a special token, goes through the whole tokenizer."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = byte_letters()

    def __missing__(self, word: str) -> bytes:
        if _PLAIN.fullmatch(word) and "<|" not in word:
            ids = []
            for piece in _PIECE.findall(word.lower()):
                if not piece.isascii():
                    piece = piece.encode().decode("latin-1").translate(self.letters)
                ids += [t.id for t in self.model.tokenize(piece)]
        else:
            ids = self.tokenizer.encode(word, add_special_tokens=False).ids
        coded = self[word] = np.array(ids, dtype="<u4").tobytes()
        return coded

    def encode(self, text: str) -> bytes:
        if len(self) > CACHED_WORDS:
            self.clear()
        return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))


_CODERS: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """The worker's coder of a tokenizer file; it outlives a task."""
    if path not in _CODERS:
        _CODERS[path] = WordIds(path)
    return _CODERS[path]


def cut_pieces(docs: DataFrame, tokenizer_path: str | None = None, sequence: int = SEQUENCE, end_id: int = END_ID,
               with_ids: bool = True, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokenizes every whole text (null: empty), ends it with ``end_id`` and cuts
    it at multiples of ``sequence``: one row per piece with doc_id, start, length,
    doc_tokens, ids_crc32, a random ``slot`` and, with ``with_ids``, the token ids
    themselves (array<int>)."""
    path = tokenizer_path or default_tokenizer()
    schema = "doc_id long, start long, length long, doc_tokens long, ids_crc32 long, slot long"
    names = ["doc_id", "start", "length", "doc_tokens", "ids_crc32", "slot"]
    if with_ids:
        schema += ", ids array<int>"
    ending = np.array([end_id], dtype="<u4").tobytes()

    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = word_ids(path)
        task = TaskContext.get()
        salt = f"{task.partitionId() if task else 0}:".encode()
        made = 0
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
            for cut in slices(texts):
                out: list[list] = [[] for _ in range(7)]
                for doc, text in zip(ids[cut], texts[cut], strict=True):
                    raw = coder.encode(text) + ending
                    total = len(raw) // 4
                    for start in range(0, total, sequence):
                        piece = raw[4 * start : 4 * (start + sequence)]
                        made += 1
                        row = (doc, start, len(piece) // 4, total, zlib.crc32(piece),
                               xxhash.xxh64_intdigest(salt + str(made).encode()) >> 1, piece)
                        for column, value in zip(out, row, strict=True):
                            column.append(value)
                arrays = [pa.array(c, pa.int64()) for c in out[:6]]
                if not with_ids:
                    yield pa.RecordBatch.from_arrays(arrays, names)
                elif out[0]:
                    flat = np.frombuffer(b"".join(out[6]), dtype="<u4").astype(np.int32)
                    offsets = np.concatenate([[0], np.cumsum(out[2])]).astype(np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [*arrays, pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], [*names, "ids"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(tokenize, schema)


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length (sorted in decreasing order by the caller).

    The tree's leaves are bins with their free capacity, every inner node holds
    the larger of its children; descending to the left child whenever it fits
    finds the first bin with room."""
    leaves = 1
    while leaves < max(1, len(lengths)):
        leaves *= 2
    tree = [capacity] * (2 * leaves)
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for i, need in enumerate(lengths.tolist()):
        node = 1
        while node < leaves:
            node *= 2
            if tree[node] < need:
                node += 1
        bins[i], offsets[i] = node - leaves, capacity - tree[node]
        tree[node] -= need
        while node > 1:
            node //= 2
            best = max(tree[2 * node], tree[2 * node + 1])
            if tree[node] == best:
                break
            tree[node] = best
    return bins, offsets


def assign_sequences(pieces: DataFrame, sequence: int = SEQUENCE, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Adds sequence_id and offset to a stored table of pieces (slot, length, ...).

    Pieces fall into groups by their random slot, so a group has about
    ``group_pieces`` rows however many rows share a document, a length or a
    text; only slot and length enter the packing itself."""
    groups = max(1, -(-pieces.count() // group_pieces))

    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["length", "slot"], ascending=[False, True], kind="stable")
        bins, offsets = first_fit_decreasing(frame["length"].to_numpy(), sequence)
        return frame.assign(sequence_id=frame["pack_group"].to_numpy("int64") * 2**32 + bins, offset=offsets).drop(columns="pack_group")

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    grouped = pieces.withColumn("pack_group", F.pmod(F.col("slot"), F.lit(groups)))
    return grouped.groupBy("pack_group").applyInPandas(pack, f"{schema}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer_path: str | None = None, sequence: int = SEQUENCE, with_ids: bool = True,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Packs documents: one row per piece with doc_id, start, length, doc_tokens,
    ids_crc32, sequence_id, offset and (``with_ids``) the piece's token ids.

    Null and empty texts are the single end id; repeated rows are packed once
    each; texts of any length are cut into full sequences and one remainder; an
    empty table gives no pieces.  The stored pieces hold the random slots, so a
    lost executor never changes a packing that has begun."""
    pieces = materialise(cut_pieces(docs, tokenizer_path, sequence, with_ids=with_ids, id_col=id_col, text_col=text_col), "pieces")
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    return assign_sequences(pieces, sequence).select(*columns, *(["ids"] if with_ids else []))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read_table(spark, sf_dir, "documents"), with_ids=False)
