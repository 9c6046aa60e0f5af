"""Packing token pieces into windows by multiway number differencing.

Documents are cut into pieces without looking at any other document, so every task does that alone.
Full windows are done then. The other pieces are dealt to groups of bounded size, and each group is
divided among its windows by Karmarkar and Karp's differencing: two partial divisions are merged by
laying the fullest window of one on the emptiest of the other, those with the largest imbalance
first. If a window exceeds the capacity, the group is divided again among more windows.
"""

from __future__ import annotations

import base64
import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.llm.common import staged, table

CAPACITY = 2048
# From what is left of a document after its full windows, an eighth is cut off, this much at most.
# Such small pieces let the differencing even out the windows that the large ones make.
SLICE = 128
# Pieces divided together in one call.
GROUP_PIECES = 1024
END_ID = 1

PIECES = "doc_id string, start long, length long, ids_crc32 long, doc_tokens long"


def cuts(tokens: int, capacity: int = CAPACITY, slice_: int = SLICE) -> list[tuple[int, int]]:
    """Start and length of the pieces of a document: full windows, the rest, and a slice of the rest."""
    full, rest = divmod(tokens, capacity)
    pieces = [(i * capacity, capacity) for i in range(full)]
    tail = min(rest // 8, slice_)
    if rest:
        pieces.append((full * capacity, rest - tail))
    if tail:
        pieces.append((tokens - tail, tail))
    return pieces


def divide(lengths: np.ndarray, windows: int) -> tuple[np.ndarray, np.ndarray]:
    """Window of each length, and the sums of the windows, by multiway differencing.

    A node of the merge tree holds its windows' sums in descending order. Merging adds one in
    descending and one in ascending order; walking the tree down again tells each leaf its window.
    """
    count = len(lengths)
    sums: list[np.ndarray | None] = []
    heap = []
    for i, length in enumerate(lengths):
        first = np.zeros(windows, np.int64)
        first[0] = length
        sums.append(first)
        heap.append((-int(length), i))
    heapq.heapify(heap)
    merged: list[tuple[int, int, np.ndarray]] = []
    while len(heap) > 1:
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        joint = sums[a] + sums[b][::-1]
        order = np.argsort(-joint, kind="stable")
        joint = joint[order]
        sums[a] = sums[b] = None
        heapq.heappush(heap, (-int(joint[0] - joint[-1]), len(sums)))
        sums.append(joint)
        merged.append((a, b, order))
    owners: list[np.ndarray | None] = [None] * len(sums)
    owners[-1] = np.arange(windows)
    for node in range(len(sums) - 1, count - 1, -1):
        a, b, order = merged[node - count]
        placed = np.empty(windows, np.int64)
        placed[order] = owners[node]
        owners[a], owners[b], owners[node] = placed, placed[::-1], None
    return np.array([owners[i][0] for i in range(count)], np.int64), sums[-1]


def assign(lengths: np.ndarray, capacity: int = CAPACITY) -> np.ndarray:
    """Window number of each length, none above ``capacity``; the number of windows rises until it fits."""
    out = np.empty(len(lengths), np.int64)
    whole = lengths >= capacity
    if (lengths > capacity).any():
        raise ValueError("a piece is longer than a window")
    out[whole] = np.arange(whole.sum())
    rest = lengths[~whole]
    if len(rest):
        windows = max(1, -(-int(rest.sum()) // capacity))
        while True:
            owner, sums = divide(rest, windows)
            if sums.max() <= capacity:
                break
            windows += 1
        out[~whole] = owner + whole.sum()
    return out


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def _encoder(ranks_path: str):
    """The byte-level BPE vocabulary, with its special token recognised in texts as the JSON form does."""
    import public_tokenizers
    import tiktoken

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    special = {"<|endoftext|>": 50256} if len(ranks) == 50256 else {}
    return tiktoken.Encoding("bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)


class _Ids:
    """Ids of a text. The quick encoder gives up on very long runs of blanks; these go through the JSON form's own."""

    def __init__(self, ranks_path: str | None, json_path: str | None) -> None:
        self.quick = _encoder(ranks_path or default_ranks())
        self.json_path, self.whole = json_path, None

    def __call__(self, text: str) -> list[int]:
        try:
            return self.quick.encode(text, allowed_special="all")
        except ValueError:
            import public_tokenizers
            from tokenizers import Tokenizer

            if self.whole is None:
                self.whole = Tokenizer.from_file(self.json_path or public_tokenizers.path("byte_bpe_50k.json"))
            return self.whole.encode(text, add_special_tokens=False).ids


def _cutter(
    ranks_path: str | None, capacity: int, slice_: int, end_id: int, with_ids: bool, json_path: str | None = None
):
    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = _Ids(ranks_path, json_path)
        for frame in frames:
            out = []
            for doc_id, text in zip(frame["doc_id"], frame["text"], strict=True):
                ids = encode(text) if text else []
                ids.append(end_id)
                raw = np.array(ids, "<u4")
                for start, length in cuts(len(ids), capacity, slice_):
                    piece = raw[start : start + length]
                    row = (doc_id, start, length, zlib.crc32(piece.tobytes()), len(ids))
                    out.append((*row, piece.astype(np.int32)) if with_ids else row)
            columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", *(["ids"] if with_ids else [])]
            yield pd.DataFrame(out, columns=columns)

    return cut


def token_pieces(
    docs: DataFrame,
    ranks_path: str | None = None,
    capacity: int = CAPACITY,
    slice_: int = SLICE,
    end_id: int = END_ID,
    with_ids: bool = False,
    json_path: str | None = None,
) -> DataFrame:
    """Pieces of every row of ``docs``: doc_id, start, length, ids_crc32, doc_tokens, on demand ids.

    ``ranks_path`` and ``json_path`` name the vocabulary in its two forms, by default the public byte-level
    BPE one. A null or empty text has the end id alone. Texts go whole, one at a time, through the tokenizer.
    Repeated rows and null ids stay; an empty table gives no rows.
    """
    # Ids travel as text: pandas would turn whole numbers beside nulls into floats.
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = PIECES + (", ids array<int>" if with_ids else "")
    pieces = rows.mapInPandas(_cutter(ranks_path, capacity, slice_, end_id, with_ids, json_path), schema)
    return pieces.withColumn("doc_id", F.col("doc_id").cast("long"))


def pack(pieces: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """``pieces`` (at least a ``length``) with sequence_id and offset in the sequence.

    Groups are dealt by row number, so no key can make one large; each holds about ``group_pieces``
    pieces whatever the input. Sequences are gapless from offset 0 and never above ``capacity``.
    An empty table gives no rows. ``pieces`` should not depend on the order of a shuffle; the query
    passes a written table.
    """
    numbered = pieces.withColumn("__row", F.monotonically_increasing_id())
    count = pieces.count()
    groups = max(1, -(-count // group_pieces))
    dealt = numbered.withColumn("__group", F.pmod(F.xxhash64("__row"), F.lit(groups)))
    columns = pieces.columns

    def place(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("__row", ignore_index=True)
        window = assign(group["length"].to_numpy(), capacity)
        group["sequence_id"] = key[0] * (1 << 24) + window
        group["offset"] = group.groupby(window)["length"].cumsum() - group["length"]
        return group[[*columns, "sequence_id", "offset"]]

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return dealt.groupBy("__group").applyInPandas(place, schema + ", sequence_id long, offset long")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_docs(table(spark, sf_dir, "documents"))


def packed_docs(docs: DataFrame, **options) -> DataFrame:
    """Every piece of ``docs`` with its place. The pieces are written once, so texts are tokenised once."""
    return pack(staged(token_pieces(docs, **options), "pieces"))
