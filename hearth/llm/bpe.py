"""Byte-level BPE by merge rounds over padded matrices.

A text is cut by the vocabulary's split pattern; a piece that is a token is that token. The
other distinct pieces of a slice of texts are put into matrices by length, one piece a row,
padded on the right. In each round every row finds its leftmost pair of least rank, replaces
it by the merged token and is compacted by one column; only the two pairs beside it are looked
up again, in an open-addressing table of hashed pairs. Rows without a pair left are taken out.

A piece wider than the widest bucket is a matrix of one row that merges many pairs a round:
every pair whose rank is the least among all pairs within the length of the longest token
(in a run of equal neighbours every other one, from the left). No token can reach further, so
nothing that happens earlier in rank order can take such a pair's parts away; the result is
that of one merge at a time, and a megabyte without white space takes some hundred rounds. This
needs a vocabulary in which every token is made by merges of ranks that never fall, which is checked;
without it such a row merges one pair a round.

Texts are encoded in their partition, slice by slice: no shuffle, and a task holds one slice
and a bounded memory of pieces. Decoding gathers the tokens' bytes.

Defined results: a null or empty text has no ids; repeated rows are encoded each; a text of
any length is encoded whole; an empty table gives an empty table; ids that are null, or an
array that holds a null or an unknown id, decode to null. Columns other than the text and
those named in ``keep`` are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pick

RANKS = "byte_bpe_multi_50k.tiktoken"
BUCKETS = (2, 3, 4, 5, 6, 8, 10, 12, 16, 24, 32, 48, 64, 96, 128, 256, 512)  # widths of the matrices
SLICE = 1 << 20        # characters (or ids) of texts handled at once; a longer text is a slice of its own
CELLS = 1 << 20        # cells of one matrix
REMEMBERED = 300_000   # distinct pieces a worker remembers
NONE = np.int32(2**31 - 1)


def _spread(keys: np.ndarray, bits: int) -> np.ndarray:
    return (keys * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - bits)).astype(np.int64)


def gather(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The runs ``flat[start:start + length]`` one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat(starts - (ends - lengths), lengths) + np.arange(total)]


class Vocabulary:
    """Token bytes by id (= rank) and the table of mergeable pairs."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.longest = max(map(len, ranks))
        size = max(ranks.values()) + 1
        by_id: list[bytes] = [b""] * size
        for token, i in ranks.items():
            by_id[i] = token
        self.lengths = np.array([len(t) for t in by_id], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.flat = np.frombuffer(b"".join(by_id), np.uint8)
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        left, right, merged = [], [], []
        for token, i in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    merged.append(i)
        self._index(np.array(left, np.uint64) << np.uint64(32) | np.array(right, np.uint64), np.array(merged, np.int32))

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        import base64
        with open(path, "rb") as f:
            return cls({base64.b64decode(a): int(b) for a, b in map(bytes.split, f)})

    def _index(self, keys: np.ndarray, merged: np.ndarray) -> None:
        """Open addressing with linear probing, at most a quarter full."""
        self.bits = max(4, int(4 * len(keys)).bit_length())
        self.keys = np.full(1 << self.bits, np.uint64(2**64 - 1))
        self.merged = np.full(1 << self.bits, NONE)
        at, self.reach = _spread(keys, self.bits), 0
        while len(keys):
            free = np.flatnonzero(self.keys[at] == np.uint64(2**64 - 1))
            _, first = np.unique(at[free], return_index=True)
            put = free[first]
            self.keys[at[put]], self.merged[at[put]] = keys[put], merged[put]
            rest = np.ones(len(keys), bool)
            rest[put] = False
            keys, merged, at = keys[rest], merged[rest], at[rest] + 1 & (1 << self.bits) - 1
            self.reach += 1

    def pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The id each pair merges into; NONE for a pair that is no token or holds padding (-1)."""
        keys = left.astype(np.int64).view(np.uint64) << np.uint64(32) | right.astype(np.int64).view(np.uint64) & np.uint64(2**32 - 1)
        at = _spread(keys, self.bits)
        found = self.keys[at]
        out = np.where(found == keys, self.merged[at], NONE)
        open_ = np.flatnonzero((found != keys) & (found != np.uint64(2**64 - 1)))
        for _ in range(self.reach):
            if not len(open_):
                break
            at[open_] = at[open_] + 1 & (1 << self.bits) - 1
            found = self.keys[at[open_]]
            hit = found == keys[open_]
            out[open_[hit]] = self.merged[at[open_[hit]]]
            open_ = open_[~hit & (found != np.uint64(2**64 - 1))]
        return out

    # ------------------------------------------------------------------ rounds
    def merge_rows(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(ids, lengths, rising)`` of rows of one padded matrix; ``rising``: its ranks never fell."""
        n, width = len(pieces), max(map(len, pieces))
        sizes = np.array([len(p) for p in pieces])
        ids = self.single[np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(n, width)]
        ids[np.arange(width) >= sizes[:, None]] = -1
        rank = self.pairs(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(n, width - 1)
        rows, last, rising = np.arange(n), np.full(n, -1), np.ones(n, bool)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(rows):
            at = rank.argmin(axis=1) if rank.shape[1] else np.zeros(len(rows), np.int64)
            best = rank[np.arange(len(rows)), at] if rank.shape[1] else np.full(len(rows), NONE)
            end = best == NONE
            if end.any():
                done.append((rows[end], ids[end]))
                rows, ids, rank, at, best = rows[~end], ids[~end], rank[~end], at[~end], best[~end]
                if not len(rows):
                    break
            rising[rows] &= best >= last[rows]
            last[rows] = best
            sizes[rows] -= 1
            k, width = np.arange(len(rows)), ids.shape[1]
            ids[k, at] = best
            ids = ids[np.arange(width) != at[:, None] + 1].reshape(len(rows), width - 1)
            rank = rank[np.arange(width - 1) != at[:, None]].reshape(len(rows), width - 2)
            before, after = np.flatnonzero(at > 0), np.flatnonzero(at < width - 2)
            rank[before, at[before] - 1] = self.pairs(ids[before, at[before] - 1], best[before])
            rank[after, at[after]] = self.pairs(best[after], ids[after, at[after] + 1])
        out = np.zeros(int(sizes.sum()), np.int32)
        starts = np.cumsum(sizes) - sizes
        for r, left in done:
            kept = np.arange(left.shape[1]) < sizes[r][:, None]
            out[(starts[r][:, None] + np.arange(left.shape[1]))[kept]] = left[kept]
        return out, sizes, rising

    @cached_property
    def ordered(self) -> bool:
        """Is every token made from its own bytes by merges whose ranks never fall?"""
        tokens = sorted((t for t in self.ranks if len(t) > 1), key=len)
        for chunk in _chunks(tokens):
            ids, sizes, rising = self.merge_rows(chunk)
            if (sizes != 1).any() or not rising.all() or (ids != [self.ranks[t] for t in chunk]).any():
                return False
        return True

    def merge_long(self, piece: bytes) -> np.ndarray:
        """Ids of one piece of any length."""
        ids = self.single[np.frombuffer(piece, np.uint8)]
        rank = np.append(self.pairs(ids[:-1], ids[1:]), NONE)
        while True:
            if self.ordered:
                pick_ = self._least_nearby(rank)
            else:
                pick_ = np.array([rank.argmin()])
                pick_ = pick_[rank[pick_] != NONE]
            if not len(pick_):
                return ids
            ids[pick_] = rank[pick_]
            keep = np.ones(len(ids), bool)
            keep[pick_ + 1] = False
            at = (np.cumsum(keep) - 1)[pick_]
            ids, rank = ids[keep], rank[keep]
            rank[at[at == len(ids) - 1]] = NONE
            inner = at[at < len(ids) - 1]
            rank[inner] = self.pairs(ids[inner], ids[inner + 1])
            back = at[at > 0] - 1
            rank[back] = self.pairs(ids[back], ids[back + 1])

    def _least_nearby(self, rank: np.ndarray) -> np.ndarray:
        """Positions of pairs to merge at once: least within reach, every other one of an equal run."""
        low, span = rank, 1
        while span <= self.longest:
            low = np.minimum(low, np.append(low[span:], np.full(min(span, len(low)), NONE)))
            span *= 2
        low = np.minimum(low, low[np.maximum(np.arange(len(low)) - span + 1, 0)])
        least = (rank == low) & (rank != NONE)
        start = np.append(True, rank[1:] != rank[:-1])
        begin = np.maximum.accumulate(np.where(start, np.arange(len(rank)), 0))
        return np.flatnonzero(least & least[begin] & ((np.arange(len(rank)) - begin) % 2 == 0))

    def encode_pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(flat ids, starts, lengths)`` of every piece, in the order given."""
        starts, lengths = np.zeros(len(pieces), np.int64), np.zeros(len(pieces), np.int64)
        out: list[np.ndarray] = []
        used = 0
        order = sorted(range(len(pieces)), key=lambda i: len(pieces[i]))
        rest = []
        for i in order:
            token = self.ranks.get(pieces[i])
            if token is None:
                rest.append(i)
            else:
                starts[i], lengths[i] = used, 1
                out.append(np.array([token], np.int32))
                used += 1
        out = [np.concatenate(out)] if out else []
        wide = next((j for j, i in enumerate(rest) if len(pieces[i]) > BUCKETS[-1]), len(rest))
        for chunk in _chunks([pieces[i] for i in rest[:wide]]):
            part, rest = rest[:len(chunk)], rest[len(chunk):]
            ids, sizes, _ = self.merge_rows(chunk)
            starts[part], lengths[part] = used + np.cumsum(sizes) - sizes, sizes
            out.append(ids)
            used += len(ids)
        for i in rest:
            ids = self.merge_long(pieces[i])
            starts[i], lengths[i] = used, len(ids)
            out.append(ids)
            used += len(ids)
        return np.concatenate(out) if out else np.zeros(0, np.int32), starts, lengths


def _chunks(pieces: list[bytes]) -> Iterator[list[bytes]]:
    """Pieces sorted by length, cut where a bucket ends or a matrix is full."""
    begin = 0
    while begin < len(pieces):
        width = next((w for w in BUCKETS if w >= len(pieces[begin])), len(pieces[begin]))
        end, most = begin, max(1, CELLS // width)
        while end < len(pieces) and len(pieces[end]) <= width and end - begin < most:
            end += 1
        yield pieces[begin:end]
        begin = end


class Encoder:
    """Ids of whole texts, with a bounded memory of distinct pieces."""

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        import regex
        self.vocabulary, self.split = vocabulary, regex.compile(pattern).findall
        self._forget()

    def _forget(self) -> None:
        self.slot: dict[str, int] = {}
        self.flat = np.zeros(0, np.int32)
        self.starts = np.zeros(0, np.int64)
        self.lengths = np.zeros(0, np.int64)

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """``(ids of all texts, ids per text)``."""
        if len(self.slot) > REMEMBERED or len(self.flat) > 16 * REMEMBERED:
            self._forget()
        cut = [self.split(t) for t in texts]
        pieces = [p for c in cut for p in c]
        slot = self.slot
        new = [p for p in dict.fromkeys(pieces) if p not in slot]
        if new:
            flat, starts, lengths = self.vocabulary.encode_pieces([p.encode("utf-8") for p in new])
            slot.update(zip(new, range(len(self.starts), len(self.starts) + len(new))))
            self.starts = np.append(self.starts, starts + len(self.flat))
            self.lengths = np.append(self.lengths, lengths)
            self.flat = np.append(self.flat, flat)
        at = np.array(list(map(slot.__getitem__, pieces)), np.int64)
        sizes = self.lengths[at]
        ends = np.append(0, np.cumsum(sizes))
        edges = np.cumsum([0, *map(len, cut)])
        return gather(self.flat, self.starts[at], sizes), np.diff(ends[edges])


def _slices(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Consecutive rows of about ``SLICE`` in size, one row at least."""
    begin, held = 0, 0
    for i, n in enumerate(sizes):
        if held and held + n > SLICE:
            yield begin, i
            begin, held = i, 0
        held += n
    if begin < len(sizes):
        yield begin, len(sizes)


def _vocabulary_path(path: str | None) -> str:
    if path is None:
        import public_tokenizers
        path = public_tokenizers.path(RANKS)
    return path


def _pattern(pattern: str | None) -> str:
    if pattern is None:
        import public_tokenizers
        pattern = public_tokenizers.PATTERN
    return pattern


def encode(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text", ranks_path: str | None = None,
           pattern: str | None = None) -> DataFrame:
    """The ``keep`` columns and ``ids`` array<int> of every row's whole text."""
    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        encoder = Encoder(Vocabulary.load(_vocabulary_path(ranks_path)), _pattern(pattern))
        for b in batches:
            sizes = [0 if n is None else n for n in pc.utf8_length(b.column(0)).to_pylist()]
            for begin, end in _slices(sizes):
                part = b.slice(begin, end - begin)
                ids, counts = encoder([t or "" for t in part.column(0).to_pylist()])
                offsets = pa.array(np.append(0, np.cumsum(counts)), pa.int32())
                yield pa.RecordBatch.from_arrays([*part.columns[1:], pa.ListArray.from_arrays(offsets, pa.array(ids))],
                                                 names=[*part.schema.names[1:], "ids"])

    rows = pick(docs, text, *keep)
    kept = ", ".join(f"`{n}` {t}" for n, t in rows.dtypes[1:])
    return rows.mapInArrow(run, f"{kept}{', ' if kept else ''}ids array<int>")


def decode(encoded: DataFrame, ids: str = "ids", ranks_path: str | None = None) -> DataFrame:
    """Every column of ``encoded`` and ``decoded`` binary, the bytes of the tokens."""
    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        v = Vocabulary.load(_vocabulary_path(ranks_path))
        for b in batches:
            column = b.schema.get_field_index(ids)
            sizes = [0 if n is None else n for n in pc.list_value_length(b.column(column)).to_pylist()]
            for begin, end in _slices(sizes):
                part = b.slice(begin, end - begin)
                lists = part.column(column)
                counts = np.array(sizes[begin:end], np.int64)
                flat = lists.flatten()
                given = np.asarray(flat.fill_null(-1), np.int64)
                known = (given >= 0) & (given < len(v.lengths))
                given = np.where(known, given, 0)
                known &= v.lengths[given] > 0
                edges = np.append(0, np.cumsum(counts))
                wrong = np.diff(np.append(0, np.cumsum(~known))[edges]) > 0
                lengths = np.where(known, v.lengths[given], 0)
                data = gather(v.flat, v.starts[given], lengths)
                offsets = np.append(0, np.cumsum(lengths))[edges].astype(np.int32)
                void = wrong | np.asarray(lists.is_null())
                decoded = pa.Array.from_buffers(
                    pa.binary(), len(counts), [pa.py_buffer(np.packbits(~void, bitorder="little").tobytes()),
                                               pa.py_buffer(offsets.tobytes()), pa.py_buffer(data.tobytes())])
                yield pa.RecordBatch.from_arrays([*part.columns, decoded], names=[*part.schema.names, "decoded"])

    kept = ", ".join(f"`{n}` {t}" for n, t in encoded.dtypes)
    return encoded.mapInArrow(run, f"{kept}, decoded binary")


def digest(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)``: digests of the ids and of what they decode to."""
    both = decode(encode(docs))
    return both.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
                       F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))
