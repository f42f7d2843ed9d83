"""Harmonic packing of tokenized documents into fixed-length sequences.

A document's ids (then the end id) are cut into pieces. A piece longer than C/(k+1) and at
most C/k tokens (C: capacity) is in class k, and a sequence of class k holds exactly k
pieces; so a worker needs only a counter per class and no worker needs another. To keep
sequences full, a remainder that would leave more than ``slack`` tokens of its place empty
is cut at floor(C/(k+1)), which fills class k+1 exactly; the small rest is classed in turn.
Pieces of class ``classes`` and above share one next-fit sequence. What is pending at the
end of a partition is packed first-fit by decreasing length.

The work is one pass without a shuffle: each task tokenizes, cuts and packs its own rows,
holding at most k-1 pending pieces (positions, not tokens) per class.

Defined results: a null or empty text is the end id alone; repeated rows are packed
separately; a text of any length is cut into full sequences and a remainder; null ids are
kept; an empty table gives an empty result; columns other than doc_id and text are not
looked at.
"""

from __future__ import annotations

import re
import zlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pick

CAPACITY = 2048
CLASSES = 16
SLACK = 6
END_ID = 1
CACHE = 200_000   # chunks whose ids a worker remembers
EMIT = 4096       # pieces a task holds before it hands them on

PIECES = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
          "sequence_id bigint, offset bigint")
# white space that does not stand singly between other characters: a text has some if one of
# the words between its spaces is empty or has some
_UNEVEN = re.compile(r"\s\s|\A\s|\s\Z|\A\Z")


class Encoder:
    """Byte-level BPE ids of whole texts as little-endian unsigned 32-bit bytes.

    The vocabulary's split pattern begins a new word at every single space, so a text
    whose white space stands singly is encoded space by space with remembered chunks. The
    chunks it has anew are encoded in one call; each begins at a token that begins with a space.
    Latin-1 chunks go through the same vocabulary as ranks; all else, and texts that hold
    an added token (such as the end of text), through the tokenizer as loaded. Both give its ids.
    """

    def __init__(self, tokenizer_path: str | None = None, ranks_path: str | None = None, pattern: str | None = None):
        import base64
        import os

        import numpy as np
        os.environ.setdefault("RAYON_NUM_THREADS", "1")
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import tiktoken
        from tokenizers import Tokenizer
        if not (tokenizer_path and ranks_path and pattern):
            import public_tokenizers as public
            tokenizer_path = tokenizer_path or public.path("byte_bpe_50k.json")
            ranks_path = ranks_path or public.path("byte_bpe_50k.tiktoken")
            pattern = pattern or public.PATTERN
        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.ranked = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.whole = Tokenizer.from_file(tokenizer_path)
        added = [t.content for t in self.whole.get_added_tokens_decoder().values() if t.content]
        self.added = re.compile("|".join(map(re.escape, added)) or r"(?!)")
        self.spaced = np.zeros(max(ranks.values()) + 1, bool)
        self.spaced[[i for token, i in ranks.items() if token.startswith(b" ")]] = True
        self.known: dict[str, bytes] = {}
        self.pack = lambda ids: np.array(ids, "<u4").tobytes()

    def __call__(self, text: str) -> bytes:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self.pack(self.whole.encode(text, add_special_tokens=False).ids)
        if self.added.search(text):
            return self.pack(self.whole.encode(text, add_special_tokens=False).ids)
        one = self.ranked.encode_ordinary
        first, *rest = text.split(" ")
        known = self.known
        new = [w for w in dict.fromkeys(rest) if w not in known]
        if not rest or _UNEVEN.search(first) or new and not self.learn(new):
            return self.pack(one(text))
        ids = self.pack(one(first)) + b"".join(map(known.__getitem__, rest))
        for w in new:
            if len(w) > 64:
                del known[w]
        if len(known) > CACHE:
            known.clear()
        return ids

    def learn(self, words: list[str]) -> bool:
        """Remember the ids of words that follow a space; none of them if one cannot be encoded apart."""
        import numpy as np

        text = " ".join(words)
        if _UNEVEN.search(text):
            return False
        ids = np.array(self.ranked.encode_ordinary(" " + text), "<u4")
        begins = (4 * np.flatnonzero(self.spaced[ids])).tolist()
        if len(begins) != len(words):
            return False
        data = ids.tobytes()
        self.known.update(zip(words, [data[i:j] for i, j in zip(begins, [*begins[1:], len(data)])]))
        return True


def cut(length: int, capacity: int = CAPACITY, classes: int = CLASSES, slack: int = SLACK) -> list[int]:
    """Piece lengths of a document of ``length`` tokens, in order."""
    out = [capacity] * (length // capacity)
    rest = length % capacity
    while rest:
        k = capacity // rest
        if k >= classes or capacity // k - rest <= slack:
            out.append(rest)
            break
        out.append(capacity // (k + 1))
        rest -= out[-1]
    return out


class Packer:
    """Fills the sequences of one worker; emits (piece, sequence, offset) when one is full."""

    def __init__(self, first_sequence: int, capacity: int, classes: int):
        self.next, self.capacity, self.classes = first_sequence, capacity, classes
        self.pending: list[list] = [[] for _ in range(classes)]
        self.small: list = []
        self.used = 0
        self.out: list = []

    def emit(self, pieces: list) -> None:
        offset = 0
        for p in pieces:
            self.out.append((*p, self.next, offset))
            offset += p[2]
        self.next += 1

    def add(self, piece: tuple) -> None:
        k = self.capacity // piece[2]
        if k < self.classes:
            self.pending[k].append(piece)
            if len(self.pending[k]) == k:
                self.emit(self.pending[k])
                self.pending[k] = []
            return
        if self.used + piece[2] > self.capacity:
            self.emit(self.small)
            self.small, self.used = [], 0
        self.small.append(piece)
        self.used += piece[2]

    def finish(self) -> None:
        left = sorted([*self.small, *[p for ps in self.pending for p in ps]], key=lambda p: -p[2])
        bins: list[list] = []
        room: list[int] = []
        for p in left:
            for i, r in enumerate(room):
                if p[2] <= r:
                    bins[i].append(p)
                    room[i] -= p[2]
                    break
            else:
                bins.append([p])
                room.append(self.capacity - p[2])
        for b in bins:
            self.emit(b)
        self.small, self.pending = [], [[] for _ in range(self.classes)]


def pack(docs: DataFrame, capacity: int = CAPACITY, classes: int = CLASSES, slack: int = SLACK, end_id: int = END_ID,
         emit_ids: bool = False, tokenizer_path: str | None = None, ranks_path: str | None = None,
         pattern: str | None = None) -> DataFrame:
    """A row per piece (``PIECES``; with ``emit_ids`` also ``ids`` array<int>).

    ``sequence_id`` is the partition number times 2^33 plus a count, so workers never
    share one and a retried task gives the same numbers.
    """
    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        encode = Encoder(tokenizer_path, ranks_path, pattern)
        end = end_id.to_bytes(4, "little")
        packer = Packer(TaskContext.get().partitionId() << 33, capacity, classes)

        def table():
            cols = list(zip(*packer.out)) or [()] * 8
            packer.out = []
            doc, start, length, crc, total, ids, seq, off = cols
            arrays = [pa.array(c, pa.int64()) for c in (doc, start, length, crc, total, seq, off)]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            if emit_ids:
                import numpy as np
                arrays.append(pa.array([np.frombuffer(i, "<u4").astype(np.int32) for i in ids], pa.list_(pa.int32())))
                names.append("ids")
            return pa.RecordBatch.from_arrays(arrays, names=names)

        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1)):
                ids = encode(text.as_py() or "") + end
                total, at = len(ids) // 4, 0
                for n in cut(total, capacity, classes, slack):
                    part = ids[4 * at:4 * (at + n)]
                    packer.add((doc, at, n, zlib.crc32(part), total, part if emit_ids else None))
                    at += n
                if len(packer.out) >= EMIT:
                    yield table()
        packer.finish()
        yield table()

    rows = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("bigint"), "text")
    return rows.mapInArrow(run, PIECES + (", ids array<int>" if emit_ids else ""))
