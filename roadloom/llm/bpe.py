"""Byte-level BPE encoding and decoding with a two-tier lookup.

A text is split by a pattern into pre-tokens. Tier one: a minimal perfect hash over the
vocabulary (hash and displace, n slots for n tokens) gives a pre-token's only possible slot;
if the slot's bytes are the pre-token, its rank is the answer. Tier two, for the misses: the
pre-token's bytes form a linked list, a heap holds the mergeable neighbours by (rank, place),
and the least one merges until none is left; stale heap entries are skipped. A pre-token of n
bytes costs O(n log n), so a long run without a break is no danger.

Each task remembers what recent pre-tokens came to, in two generations of a bounded number
of entries: when the young one is full it becomes the old one, and what is used again moves
back, so frequent pre-tokens are never forgotten. Forgetting costs time only, and all of it is
let go at the task's end: a Python worker that is used again keeps nothing for other stages.
The vocabulary is a parameter (a rank file's path). It is read where the session runs and sent
to the workers as one broadcast; it has a fixed size, whatever the data's.

Decoding joins the tokens' bytes, so decode(encode(t)) is t for every text.

Defined results: null counts as the empty text, which has no tokens. Special tokens are not
known: their strings are ordinary text. Each row is handled alone; repeated rows, ties and
extra columns change nothing. An empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame

from . import common as C

REMEMBER = 160_000  # entries of a generation; about 35 MB
LONG = 64  # pre-tokens of more bytes than this are not remembered


def read_ranks(path: str) -> list[bytes]:
    """Tokens by rank from a rank file: base64 and rank on each line."""
    with open(path, "rb") as f:
        found = {int(r): base64.b64decode(t) for t, r in (line.split() for line in f if line.strip())}
    if sorted(found) != list(range(len(found))):
        raise ValueError("ranks must be 0 to n - 1")
    return [found[i] for i in range(len(found))]


class PerfectHash:
    """Minimal perfect hash of byte strings: slot(key) is its own number below n for each
    known key. Keys fall into small groups; a group gets the first displacement that puts
    all of its keys on free slots, large groups first; single keys get their slot itself."""

    def __init__(self, keys: list[bytes]):
        self.n = n = len(keys)
        self.groups = max(1, n // 3)
        self.shift = np.zeros(self.groups, np.int64)
        by: dict[int, list[int]] = {}
        h = [xxhash.xxh64_intdigest(k) for k in keys]
        for i, x in enumerate(h):
            by.setdefault(x % self.groups, []).append(i)
        taken = bytearray(n)
        at = [0] * n
        free = 0
        for g in sorted(by, key=lambda g: -len(by[g])):
            own = by[g]
            if len(own) == 1:
                while taken[free]:
                    free += 1
                taken[free], at[own[0]], self.shift[g] = 1, free, -free - 1
                continue
            d = 1
            while True:
                slots = {self._slot(h[i], d) for i in own}
                if len(slots) == len(own) and not any(taken[s] for s in slots):
                    break
                d += 1
            self.shift[g] = d
            for i in own:
                at[i] = self._slot(h[i], d)
                taken[at[i]] = 1
        self.keys, self.rank = [b""] * n, [0] * n
        for i, s in enumerate(at):
            self.keys[s], self.rank[s] = keys[i], i
        self.shift = self.shift.tolist()

    def _slot(self, h: int, d: int) -> int:
        return ((h ^ (d * 0x9E3779B97F4A7C15)) * 0xC2B2AE3D27D4EB4F >> 40 & 0xFFFFFFFFFF) % self.n

    def tokens(self) -> list[bytes]:
        """The keys by rank."""
        out = [b""] * self.n
        for key, rank in zip(self.keys, self.rank, strict=True):
            out[rank] = key
        return out

    def get(self, key: bytes) -> int | None:
        """The rank of a token; None for anything else."""
        if not self.n:
            return None
        h = xxhash.xxh64_intdigest(key)
        d = self.shift[h % self.groups]
        s = -d - 1 if d < 0 else self._slot(h, d)
        return self.rank[s] if self.keys[s] == key else None


def merge(piece: bytes, rank) -> list[int]:
    """Ranks of a piece that is no token itself, by a heap over linked bytes.

    rank: the rank of the bytes of a part, None if they are no token. A heap entry is one
    number: rank, place of the left part, end of the right part.
    """
    n = len(piece)
    wide = n + 1
    end = list(range(1, wide))  # where the part that starts here ends; 0 if none starts here
    before = list(range(-1, n - 1))  # where the part before it starts
    heap = [(r * wide + i) * wide + i + 2 for i in range(n - 1) if (r := rank(piece[i : i + 2])) is not None]
    heapq.heapify(heap)
    pop, push = heapq.heappop, heapq.heappush
    while heap:
        x, stop = divmod(pop(heap), wide)
        i = x % wide
        j = end[i]
        if not j or j >= n or end[j] != stop:
            continue  # one of the two parts has changed since
        end[j] = 0
        end[i] = stop
        if stop < n:
            before[stop] = i
            if (r := rank(piece[i : end[stop]])) is not None:
                push(heap, (r * wide + i) * wide + end[stop])
        b = before[i]
        if b >= 0 and (r := rank(piece[b:stop])) is not None:
            push(heap, (r * wide + b) * wide + stop)
    out, i = [], 0
    while i < n:
        j = end[i]
        out.append(rank(piece[i:j]))
        i = j
    return out


class Memory(dict):
    """Ids by pre-token: found by the perfect hash, else by merging; two generations."""

    def __init__(self, known: PerfectHash, rank, most: int):
        super().__init__()
        self.known, self.rank, self.most, self.old = known, rank, most, {}

    def __missing__(self, piece: str) -> tuple[int, ...]:
        ids = self.old.get(piece)
        if ids is None:
            raw = piece.encode("utf-8", "surrogatepass")
            r = self.known.get(raw)
            ids = (r,) if r is not None else tuple(merge(raw, self.rank))
            if len(raw) > LONG:
                return ids
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        self[piece] = ids
        return ids


class Encoder:
    def __init__(self, known: PerfectHash, pattern: str):
        self.tokens = known.tokens()
        self.digits = [str(i) for i in range(known.n)]
        parts = {t: i for i, t in enumerate(self.tokens)}  # ranks of what merges make
        self.split = regex.compile(pattern).findall
        self.memory = Memory(known, parts.get, REMEMBER)

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(map(self.memory.__getitem__, self.split(text))))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def _run(shared, pattern: str, ids_too: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Encoder(shared.value, pattern)  # this task's only: nothing stays in the worker
        digits = coder.digits
        for batch in batches:
            counts, names, raws, lists = [], [], [], []
            for text in batch.column(1).to_pylist():
                ids = coder.encode(text) if text else []
                counts.append(len(ids))
                names.append(hashlib.sha256(",".join(map(digits.__getitem__, ids)).encode()).hexdigest())
                raws.append(hashlib.sha256(coder.decode(ids)).hexdigest())
                if ids_too:
                    lists.append(ids)
            cols = [batch.column(0), pa.array(counts, pa.int64()), pa.array(names, pa.string()), pa.array(raws, pa.string())]
            heads = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if ids_too:
                cols.append(pa.array(lists, pa.list_(pa.int32())))
                heads.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names=heads)

    return run


def tokenized(docs: DataFrame, path: str | None = None, pattern: str | None = None, ids: bool = True) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256 and, unless
    ids=False, the ids themselves as array<int>."""
    spark = docs.sparkSession
    C.small_batches(spark)
    shared = spark.sparkContext.broadcast(PerfectHash(read_ranks(path or default_path())))
    slim = C.pick(docs, "doc_id", "text")
    schema = f"doc_id {dict(slim.dtypes)['doc_id']}, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * ids
    return slim.mapInArrow(_run(shared, pattern or default_pattern(), ids), schema)


def detokenized(tokens: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and text from doc_id and ids; null ids give the empty text."""
    spark = tokens.sparkSession
    shared = spark.sparkContext.broadcast(read_ranks(path or default_path()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            texts = [b"".join(map(known.__getitem__, ids or [])).decode("utf-8", "replace") for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    slim = C.pick(tokens, "doc_id", "ids")
    return slim.mapInArrow(run, f"doc_id {dict(slim.dtypes)['doc_id']}, text string")


# --- queries --------------------------------------------------------------------------


def op7_byte_bpe(spark, sf_dir: str) -> DataFrame:
    """All documents, encoded and decoded; digests of both."""
    return tokenized(C.table(spark, sf_dir, "documents"), ids=False)


QUERIES = {"op7_byte_bpe": op7_byte_bpe}
SQL: dict[str, str] = {}
