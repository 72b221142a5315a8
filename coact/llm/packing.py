"""Packing documents into sequences of a fixed length by local search.

Whole texts become token ids (``piece_table``); a document longer than a
sequence is cut from its end, so that only its first piece may be shorter.
Pieces are dealt by a hash of their row number into shards of about
``SHARD_PIECES``; the number of shards follows the number of pieces, so a shard
fits one task at any size and no source or repeated text can gather in one.
A shard starts from best-fit decreasing and then searches: documents of the
emptiest bins are moved into gaps of fuller bins, exchanged one for one, or two
for one, whenever the sum of squared fills grows; a bin that runs empty is
dropped, and the search goes on with the next emptiest until nothing improves.

Defined results: a null or empty text is one piece of the end id alone; ties go
to the bin with the lower number; repeated rows are packed each; an empty table
gives no row.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged
from .tokens import default_path, encoder

CAPACITY = 2048
END_ID = 0
SHARD_PIECES = 20_000
DONORS = 64          # emptiest bins that a round of the search empties


def piece_table(df: DataFrame, capacity: int = CAPACITY, path: str | None = None,
                end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every piece of every row."""
    path = path or default_path()
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode
        for b in batches:
            row, piece, start, length, crc = [], [], [], [], []
            for k, ids in enumerate(encode(b.column(1).to_pylist())):
                ids += end
                n = len(ids) // 4
                first = (n - 1) % capacity + 1
                for p, at in enumerate([0, *range(first, n, capacity)]):
                    size = first if at == 0 else capacity
                    row.append(k)
                    piece.append(p)
                    start.append(at)
                    length.append(size)
                    crc.append(zlib.crc32(ids[4 * at:4 * (at + size)]))
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
                 pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                ["doc_id", "piece", "start", "length", "ids_crc32"])

    kind = dict(df.dtypes)[id_col]
    return (df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
            .mapInArrow(cut, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long"))


class Bins:
    """Bins of one shard; items are named by position in ``lengths``."""

    def __init__(self, lengths: np.ndarray, capacity: int):
        self.lengths, self.capacity = lengths.tolist(), capacity
        self.items: list[list[int]] = []
        self.fill: list[int] = []

    def best_fit(self) -> None:
        """Longest first, each into the fullest bin that has room for it."""
        by_room: list[list[int]] = [[] for _ in range(self.capacity + 1)]
        rooms = 0                    # bit r: a bin has room r
        for k in sorted(range(len(self.lengths)), key=lambda k: -self.lengths[k]):
            n = self.lengths[k]
            fits = rooms >> n
            if n and fits:
                room = n + (fits & -fits).bit_length() - 1
                b = by_room[room].pop()
                if not by_room[room]:
                    rooms &= ~(1 << room)
                self.items[b].append(k)
                self.fill[b] += n
            else:
                room, b = self.capacity, len(self.items)
                self.items.append([k])
                self.fill.append(n)
            left = room - n
            if left:
                by_room[left].append(b)
                rooms |= 1 << left

    def _swap(self, target: int, out: list[int], source: list[tuple[int, int]]) -> bool:
        """Exchange ``out`` (items of the target) for ``source`` ((bin, item)
        pairs). False, and nothing changes, if a donor has no room for what
        comes back or the sum of squared fills would not grow."""
        after = {target: self.fill[target]}
        for b, k in source:
            after[b] = after.get(b, self.fill[b]) - self.lengths[k]
            after[target] += self.lengths[k]
        back = {}
        for k in out:
            rooms = [b for b in after if b != target and after[b] + self.lengths[k] <= self.capacity]
            if not rooms:
                return False
            back[k] = max(rooms, key=lambda b: (after[b], -b))
            after[back[k]] += self.lengths[k]
            after[target] -= self.lengths[k]
        if sum(f * f for f in after.values()) <= sum(self.fill[b] ** 2 for b in after):
            return False
        for b, k in source:
            self.items[b].remove(k)
            self.items[target].append(k)
            self.fill[b] -= self.lengths[k]
            self.fill[target] += self.lengths[k]
        for k, b in back.items():
            self.items[target].remove(k)
            self.items[b].append(k)
            self.fill[target] -= self.lengths[k]
            self.fill[b] += self.lengths[k]
        return True

    def search(self) -> None:
        """Empty the emptiest bins into the gaps of the others, round by round."""
        lowest = None
        while True:
            order = sorted((b for b in range(len(self.items)) if self.items[b] and self.fill[b] < self.capacity),
                           key=lambda b: (self.fill[b], b))
            state = (len(order), sum(self.fill[b] ** 2 for b in order))
            if len(order) < 2 or state == lowest:
                return
            lowest = state
            donors = order[:min(DONORS, max(1, len(order) // 2))]
            self._round(donors, order[len(donors):][::-1])
            if not any(not self.items[b] for b in donors):
                return

    def _round(self, donors: list[int], targets: list[int]) -> None:
        cap = self.capacity
        pool: list[list[tuple[int, int]]] = [[] for _ in range(cap + 1)]
        for b in donors:
            for k in self.items[b]:
                pool[self.lengths[k]].append((b, k))

        def floors() -> np.ndarray:
            have = np.array([n if pool[n] else 0 for n in range(cap + 1)])
            return np.maximum.accumulate(have)

        floor = floors()
        for t in targets:
            while True:
                gap = cap - self.fill[t]
                if not gap:
                    break
                best, plan = 0, None
                n = int(floor[gap])                      # move
                if n:
                    best, plan = n, ([], [n])
                if best < gap:
                    for k in self.items[t]:
                        own = self.lengths[k]
                        n = int(floor[min(cap, own + gap)])      # one for one
                        if n - own > best:
                            best, plan = n - own, ([k], [n])
                        if best == gap:
                            break
                        reach = own + gap                       # two for one
                        have = np.flatnonzero(floor[1:min(cap, reach - 1) + 1] == np.arange(1, min(cap, reach - 1) + 1)) + 1
                        if len(have):
                            second = floor[reach - have]
                            both = np.where(second > 0, have + second, 0)
                            at = int(both.argmax())
                            a, b = int(have[at]), int(second[at])
                            if both[at] - own > best and (a != b or len(pool[a]) > 1):
                                best, plan = int(both[at]) - own, ([k], [a, b])
                        if best == gap:
                            break
                if plan is None:
                    break
                out, wanted = plan
                source = [pool[n].pop() for n in wanted]
                if not self._swap(t, out, source):
                    for n, s in zip(wanted, source):
                        pool[n].append(s)
                    break
                for k in out:
                    b = next(b for b, _ in source if k in self.items[b])
                    pool[self.lengths[k]].append((b, k))
                floor = floors()


def pack_lengths(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Bin number and offset of every item of one shard."""
    bins = Bins(lengths, capacity)
    bins.best_fit()
    bins.search()
    number, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for b, items in enumerate(x for x in bins.items if x):
        at = 0
        for k in items:
            number[k], offset[k] = b, at
            at += int(lengths[k])
    return number, offset


def pack(pieces: DataFrame, capacity: int = CAPACITY, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``."""
    columns = pieces.columns
    shards = max(1, -(-pieces.count() // shard_pieces))
    dealt = pieces.withColumn(
        "shard", F.pmod(F.xxhash64(F.lit("deal"), F.monotonically_increasing_id()), F.lit(shards)))

    def packed(pdf: pd.DataFrame) -> pd.DataFrame:
        number, offset = pack_lengths(pdf["length"].to_numpy(), capacity)
        pdf["sequence_id"] = (pdf["shard"].to_numpy() << 32) + number
        pdf["offset"] = offset
        return pdf[[*columns, "sequence_id", "offset"]]

    schema = pieces.withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")}).schema
    return dealt.groupBy("shard").applyInPandas(packed, schema)


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    return pack(staged(piece_table(docs, capacity, path), "pieces"), capacity)
