"""Byte-pair encoding and decoding with the vocabulary of a public tokenizer.

Texts are split into pieces (contractions, words, numbers, signs, white space) by numpy
masks over code points. A piece is encoded once and looked up from then on: its bytes form
a doubly linked list of symbols, and a priority queue holds the ranks of neighbours that
can merge; an entry whose symbols have changed since is stale, and skipped. Decoding
concatenates the vocabulary's byte strings. The vocabulary is a file of base64 tokens and
ranks, whose path is a parameter; nothing is trained.
"""

from __future__ import annotations

import base64
import heapq
import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.llm import kernels as K
from quern.llm import store

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: How this vocabulary splits texts; split() does the same.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Pieces whose tokens a worker remembers.
CACHED = 600_000

_OTHER, _LETTER, _NUMBER, _SPACE = range(4)


def load_ranks(path: str = VOCABULARY) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def merge_piece(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Tokens of a piece: the neighbours of least rank, of these the leftmost, merge until none can."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    symbol: list[bytes | None] = [piece[i : i + 1] for i in range(n)]
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    queue = []
    for i in range(n - 1):
        rank = ranks.get(piece[i : i + 2])
        if rank is not None:
            queue.append((rank, i, 2))
    heapq.heapify(queue)
    while queue:
        _, i, size = heapq.heappop(queue)
        left = symbol[i]
        if left is None or (j := after[i]) == n:
            continue
        right = symbol[j]
        if len(left) + len(right) != size:
            continue
        merged = left + right
        symbol[i], symbol[j] = merged, None
        after[i] = k = after[j]
        if k < n:
            before[k] = i
            rank = ranks.get(merged + symbol[k])
            if rank is not None:
                heapq.heappush(queue, (rank, i, size + len(symbol[k])))
        h = before[i]
        if h >= 0:
            rank = ranks.get(symbol[h] + merged)
            if rank is not None:
                heapq.heappush(queue, (rank, h, size + len(symbol[h])))
    return [ranks[s] for s in symbol if s is not None]


_classes: list[np.ndarray] = []


def char_classes() -> np.ndarray:
    """Letter, number, white space or other, for every code point."""
    if not _classes:
        table = np.zeros(0x110000, np.uint8)
        every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
        for kind, pattern in ((_LETTER, r"\p{L}+"), (_NUMBER, r"\p{N}+"), (_SPACE, r"\p{White_Space}+")):
            for m in regex.finditer(pattern, every):
                a, b = ord(m[0][0]), ord(m[0][-1])
                if b - a == len(m[0]) - 1:
                    table[a : b + 1] = kind
                else:  # a match that runs across the surrogates
                    table[list(map(ord, m[0]))] = kind
        _classes.append(table)
    return _classes[0]


def split(points: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Where the pieces of PATTERN begin, in code points; off has the n + 1 offsets of texts."""
    n = len(points)
    if n == 0:
        return np.zeros(0, np.int64)
    kind = char_classes()[points]
    fresh = np.zeros(n + 1, bool)  # the first character of a text
    fresh[off] = True
    begins = fresh[:n].copy()
    begins[1:] |= kind[1:] != kind[:-1]
    start = np.flatnonzero(begins)
    end = np.append(start[1:], n)
    on = ~fresh[end]  # its text goes on after this run
    # White space before something: its last character stands alone or, if a blank, goes with what follows.
    s = np.flatnonzero((kind[start] == _SPACE) & on)
    begins[end[s] - 1] = True
    begins[end[s][points[end[s] - 1] == 32]] = False
    # Contractions: an apostrophe that begins a piece, and one or two letters after it.
    q = np.flatnonzero((points[start] == 39) & (end - start == 1) & on & begins[start])
    q = q[kind[end[q]] == _LETTER]
    if len(q):
        i, stop = start[q], end[np.minimum(q + 1, len(end) - 1)]
        one = points[i + 1]
        two = np.where(i + 2 < stop, points[np.minimum(i + 2, n - 1)], 0)
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = np.zeros(len(i), bool)
        for a, b in ("re", "ve", "ll"):
            long |= (one == ord(a)) & (two == ord(b))
        size = np.where(short, 1, np.where(long, 2, 0))
        hit = size > 0
        begins[i[hit] + 1] = False
        next_ = i[hit] + 1 + size[hit]
        begins[next_[next_ < stop[hit]]] = True
    return np.flatnonzero(begins)


class Encoder:
    """Encodes batches of texts; remembers the tokens of up to CACHED pieces.

    encode_pieces gives the tokens of all pieces, one after another, and how many each has.
    """

    def __init__(self, encode_pieces: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], cached: int = CACHED) -> None:
        self.encode_pieces, self.cached = encode_pieces, cached
        self._forget()

    def _forget(self) -> None:
        self.key = np.zeros(0, np.uint64)
        self.at = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int32)
        self.pool = np.zeros(1 << 16, np.int32)
        self.used = 0

    def _learn(self, keys: np.ndarray, pieces: list[str]) -> None:
        flat, size = self.encode_pieces(pieces)
        if self.used + len(flat) > len(self.pool):
            self.pool = np.concatenate([self.pool[: self.used], np.zeros(max(self.used, len(flat)) + 1, np.int32)])
        self.pool[self.used : self.used + len(flat)] = flat
        at = self.used + np.cumsum(size) - size
        self.used += len(flat)
        place = np.searchsorted(self.key, keys)
        self.key, self.at, self.size = np.insert(self.key, place, keys), np.insert(self.at, place, at), np.insert(self.size, place, size)

    def __call__(self, buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of UTF-8 texts, and the n + 1 places where texts begin among them."""
        text = buf.tobytes().decode()
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        chars = np.zeros(len(buf) + 1, np.int64)
        np.cumsum((buf & 0xC0) != 0x80, out=chars[1:])
        off = chars[off]
        start = split(points, off)
        if not len(start):
            return np.zeros(0, np.int32), np.zeros(len(off), np.int64)
        end = np.append(start[1:], len(points))
        keys, first, which = np.unique(K.spans_hash(points, start, end), return_index=True, return_inverse=True)
        if len(self.key) + len(keys) > self.cached:
            self._forget()
        place = np.searchsorted(self.key, keys)
        known = np.zeros(len(keys), bool)
        inside = place < len(self.key)
        known[inside] = self.key[place[inside]] == keys[inside]
        new = np.flatnonzero(~known)
        if len(new):
            self._learn(keys[new], [text[a:b] for a, b in zip(start[first[new]].tolist(), end[first[new]].tolist())])
            place = np.searchsorted(self.key, keys)
        size = self.size[place].astype(np.int64)[which]
        at = self.at[place][which]
        last = np.cumsum(size)
        tokens = self.pool[np.repeat(at - last + size, size) + np.arange(last[-1])]
        pieces = np.searchsorted(start, off)
        return tokens, np.concatenate([[0], last])[pieces]


def one_by_one(encode_piece: Callable[[str], list[int]]) -> Callable[[list[str]], tuple[np.ndarray, np.ndarray]]:
    """What Encoder needs, from a function of one piece."""

    def encode(pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        tokens = [encode_piece(p) for p in pieces]
        size = np.array([len(t) for t in tokens], np.int32)
        return np.fromiter((t for ts in tokens for t in ts), np.int32, int(size.sum())), size

    return encode


def queue_encoder(path: str = VOCABULARY) -> Encoder:
    """Pieces are merged with the priority queue of this module."""
    ranks = load_ranks(path)
    return Encoder(one_by_one(lambda piece: merge_piece(piece.encode(), ranks)))


def library_encoder(path: str = VOCABULARY) -> Encoder:
    """Pieces are merged by the tiktoken library; the same tokens, sooner.

    The library gets all pieces in one text, with a null character between them. Where a piece has that
    character itself, or the vocabulary lacks it, they go one by one.
    """
    import tiktoken

    ranks = load_ranks(path)
    between = ranks.get(b"\0")
    one = tiktoken.Encoding("quern", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    many = tiktoken.Encoding("quern-pieces", pat_str=r"[^\x00]+|\x00", mergeable_ranks=ranks, special_tokens={})
    singly = one_by_one(one.encode_ordinary)

    def encode(pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        text = "\0".join(pieces)
        if between is None or text.count("\0") != len(pieces) - 1:
            return singly(pieces)
        got = np.array(many.encode_ordinary(text), np.int32)
        cuts = np.flatnonzero(got == between)
        return np.delete(got, cuts), (np.diff(cuts, prepend=-1, append=len(got)) - 1).astype(np.int32)

    return Encoder(encode)


def encoder(kind: str, path: str) -> Encoder:
    """An encoder for a task. It isn't kept beyond: the vocabulary and the pieces would stay in every worker, whatever it does next."""
    return {"queue": queue_encoder, "library": library_encoder}[kind](path)


def with_tokens(docs: DataFrame, text_col: str = "text", tokens_col: str = "tokens", count_col: str | None = None, path: str = VOCABULARY, kind: str = "queue", keep: bool = True, binary: bool = False) -> DataFrame:
    """docs with tokens_col, the token ids of text_col (array of int), as last column.

    Instead of the ids, with keep false, only their number is added, as count_col (int); with both,
    count_col comes before tokens_col. With binary, tokens_col has the ids' bytes, four for each, which cost much less to write and shuffle than an array. A null text gives null, an empty one no tokens. Texts of
    any length are encoded whole. Rows are handled each on its own, so ids may repeat or be
    null, and an empty table gives an empty one. A column of docs that has the name of a new one is replaced.
    No shuffle; every worker reads the vocabulary from path, which must be there on each machine.
    """
    added = [*([count_col] if count_col else []), *([tokens_col] if keep else [])]
    rest = [c for c in docs.columns if c not in added]
    src = docs.select(*[docs[c] for c in rest], F.col(text_col).alias(store.unused(rest, "__text")))
    schema = docs.select(*rest).schema
    for c in added:
        schema = schema.add(c, (T.BinaryType() if binary else T.ArrayType(T.IntegerType())) if keep and c == tokens_col else T.IntegerType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(kind, os.path.expanduser(path))
        for batch in batches:
            text = batch.column(batch.num_columns - 1)
            missing = text.is_null().to_numpy(zero_copy_only=False)
            buf, off = K.utf8(text)
            for lo, hi in K.blocks(off):
                tokens, first = encode(buf[off[lo] : off[hi]], off[lo : hi + 1] - off[lo])
                gone = pa.array(missing[lo:hi])
                columns = batch.slice(lo, hi - lo).columns[:-1]
                if count_col:
                    columns.append(pa.array(np.diff(first).astype(np.int32), mask=missing[lo:hi]))
                if keep and binary:
                    here = pa.array(~missing[lo:hi])
                    columns.append(pa.Array.from_buffers(pa.binary(), hi - lo, [here.buffers()[1], pa.py_buffer((4 * first).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(tokens, np.dtype("<i4")))]))
                elif keep:
                    ids = K.lists(tokens, first, pa.int32())
                    if missing[lo:hi].any():
                        ids = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(tokens), mask=gone)
                    columns.append(ids)
                yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:-1], *added])

    return src.mapInArrow(K.tidy(run), schema)


class Decoder:
    """Turns token ids into texts."""

    def __init__(self, path: str = VOCABULARY) -> None:
        ranks = load_ranks(path)
        words: list[bytes] = [b""] * (max(ranks.values()) + 1)
        for word, rank in ranks.items():
            words[rank] = word
        self.pool = np.frombuffer(b"".join(words), np.uint8)
        self.size = np.array([len(w) for w in words], np.int64)
        self.at = np.cumsum(self.size) - self.size

    def __call__(self, tokens: np.ndarray, first: np.ndarray) -> list[str]:
        """Texts of token lists; bytes that aren't UTF-8 become U+FFFD. Unknown ids are an error."""
        if len(tokens) and (tokens.min() < 0 or tokens.max() >= len(self.size)):
            raise ValueError("token id outside the vocabulary")
        size = self.size[tokens]
        last = np.cumsum(size)
        total = int(last[-1]) if len(last) else 0
        raw = self.pool[np.repeat(self.at[tokens] - last + size, size) + np.arange(total)].tobytes()
        bound = np.concatenate([[0], last])[first].tolist()
        return [raw[a:b].decode("utf-8", "replace") for a, b in zip(bound, bound[1:])]


def with_text(df: DataFrame, tokens_col: str = "tokens", text_col: str = "decoded", path: str = VOCABULARY) -> DataFrame:
    """df with text_col, the text that the ids of tokens_col stand for, as last column.

    Null gives null, no tokens an empty text; bytes that don't form UTF-8 become U+FFFD; an id
    that the vocabulary lacks is an error. What with_tokens made gives back the text exactly.
    """
    rest = [c for c in df.columns if c != text_col]
    src = df.select(*rest, F.col(tokens_col).alias(store.unused(rest, "__tokens")))
    schema = df.select(*rest).schema.add(text_col, T.StringType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = Decoder(os.path.expanduser(path))
        for batch in batches:
            tokens = batch.column(batch.num_columns - 1)
            first = tokens.offsets.to_numpy().astype(np.int64)
            texts = decode(tokens.values.to_numpy()[first[0] : first[-1]], first - first[0])
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string(), mask=tokens.is_null().to_numpy(zero_copy_only=False))], [*batch.schema.names[:-1], text_col])

    return src.mapInArrow(K.tidy(run), schema)
