"""Byte-level BPE: encoding by rank, with a segment tree over byte positions, and decoding.

Text is cut into pieces by the tokenizer's pattern. In a piece every byte starts as a token of its own. Leaf ``i`` of the
tree holds the rank of the pair whose left token starts at byte ``i``, together with ``i``; inner nodes hold the smaller
of their children, so the root is the leftmost pair of the lowest rank. A merge changes three leaves (the merged
pair, its right token, and the pair of the left neighbour), each in a logarithmic number of steps.

Edge cases: a null or empty text has no ids and decodes to no bytes; repeated rows are encoded one by one; any text
round-trips, as every single byte has a rank (a rank file without one is refused); a very long text is encoded piece by piece, whole;
an empty table gives no rows; other columns are not read, so their names can't clash.
"""

from __future__ import annotations

import base64
from functools import lru_cache
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from starmill.llm.texts import id_and_text, map_texts

CACHED_PIECES = 400_000


@lru_cache(maxsize=4)
def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    if any(bytes([b]) not in ranks for b in range(256)):
        raise ValueError(f"{path} has no rank for some single byte")
    return ranks


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one piece: the pair of the lowest rank is merged, the leftmost first, until no pair has a rank."""
    if piece in ranks:
        return [ranks[piece]]
    n = len(piece)
    leaves = 1 << (n - 1).bit_length()
    none = 1 << 62  # above every entry
    rank_of = ranks.get
    tree = [none] * (2 * leaves)
    for i in range(n - 1):
        rank = rank_of(piece[i:i + 2])
        if rank is not None:
            tree[leaves + i] = rank * leaves + i
    for node in range(leaves - 1, 0, -1):
        left, right = tree[2 * node], tree[2 * node + 1]
        tree[node] = left if left < right else right
    after = list(range(1, n + 1))  # where the next live token starts
    before = list(range(-1, n))
    while tree[1] < none:
        i = tree[1] & (leaves - 1)
        gone = after[i]
        end = after[gone]
        after[i] = end
        if end < n:
            before[end] = i
            rank = rank_of(piece[i:after[end]])
            changes = [(gone, none), (i, none if rank is None else rank * leaves + i)]
        else:
            changes = [(gone, none), (i, none)]
        left = before[i]
        if left >= 0:
            rank = rank_of(piece[left:end])
            changes.append((left, none if rank is None else rank * leaves + left))
        for leaf, entry in changes:
            node = leaves + leaf
            if tree[node] == entry:
                continue
            tree[node] = entry
            while node > 1:
                other = tree[node ^ 1]
                if other < entry:
                    entry = other
                node >>= 1
                if tree[node] == entry:
                    break
                tree[node] = entry
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i:after[i]]])
        i = after[i]
    return ids


class Pieces(dict):
    """Ids by piece, of the pieces met lately in this process."""

    def __init__(self, ranks: dict[bytes, int], most: int = CACHED_PIECES):
        super().__init__()
        self.ranks, self.most = ranks, most

    def __missing__(self, piece: str) -> list[int]:
        ids = merge(piece.encode(), self.ranks)
        if len(piece) <= 64:
            if len(self) >= self.most:
                self.clear()
            self[piece] = ids
        return ids


class Codec:
    """Encoder and decoder of one rank file."""

    def __init__(self, path: str, pattern: str):
        ranks = load_ranks(path)
        self.find = regex.compile(pattern).findall
        self.pieces = Pieces(ranks)
        self.bytes_of = {rank: token for token, rank in ranks.items()}

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(map(self.pieces.__getitem__, self.find(text))))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids array<int>, decoded binary (the bytes that these ids stand for), a row for each row of ``docs``.

    ``path`` is a rank file that every executor can read, ``pattern`` cuts the text into pieces.
    """

    def run(batch: pa.RecordBatch, texts: list[str]):
        own = codec(path, pattern)
        ids = [own.encode(t) for t in texts]
        return batch.column("doc_id"), ids, [own.decode(x) for x in ids]

    return map_texts(id_and_text(docs, id_col, text_col), run, "doc_id long, ids array<int>, decoded binary")


def decode(encoded: DataFrame, path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id, decoded binary; null ids decode to no bytes, an unknown id is an error."""

    def run(batches):
        own = codec(path, pattern)
        for batch in batches:
            ids = [own.decode(x or []) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(ids, pa.binary())],
                                             names=["doc_id", "decoded"])

    return encoded.select(id_col, ids_col).mapInArrow(run, "doc_id long, decoded binary")
