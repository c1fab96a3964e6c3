"""Byte-level BPE as a monoid: a text's encoding is a tree reduction over its halves.

Two levels use the same idea. (1) The pattern cuts a text into pieces. A space that has something other than
white space on one side (before it, or after it) is a cut whatever else stands in the text, so spans between
such spaces are leaves whose join needs no window. Where a text has other runs of white space, a node of the tree
holds the pieces of its span and two neighbours are joined by cutting a window around the border again. The window starts at
the last piece of the left node whose cut cannot depend on what follows the border, and grows until one
of its cuts falls on a cut of the right node: from there on both cuttings read the same characters from
the same place, so every later piece is proven unchanged. (2) A piece of many bytes is encoded by halves
too. A token sequence is the BPE encoding of its bytes exactly if every two adjacent tokens are (the merge
order is total and each token encodes to itself), so a join re-encodes a window of tokens on either side of
the border, growing until the pairs at its two edges are stable. Decoding concatenates up the tree.

A leaf of the piece tree is a run of at most ``LEAF_BYTES`` bytes. The leaves that a batch of texts needs are merged
together, a row each (:class:`BulkMerge`); longer pieces join leaves. Work is cut by documents; a task holds one batch of rows and a cache of encoded pieces of bounded size.
Defined cases: null and empty texts have no tokens and decode to no bytes; repeated rows give repeated
results; other columns are ignored.
"""

from __future__ import annotations

import base64
import gc
import hashlib
import re
from collections.abc import Callable, Iterator
from functools import cached_property, lru_cache
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from histora.llm.common import batched, ship

#: Characters of a leaf of the text tree, bytes of a leaf of the piece tree, and cached pieces at most.
LEAF_CHARS = 8192
LEAF_BYTES = 16
LEAF_IDS = 4096
PREPARED_CHARS = 1 << 19   # texts whose leaves are encoded together
LONG_BYTES = 200   # from here on a heap finds the next merge
CACHE_PIECES = 320_000

_LOOKAHEAD = 3   # characters after a piece that its cut can depend on, white space runs aside


def read_ranks(lines: list[str]) -> dict[bytes, int]:
    """Token bytes to rank, from the lines of a rank file (base64 text, space, decimal rank)."""
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


class _Cache(dict):
    """Encodings by text, in two generations of half of ``most`` texts each: when the young one is full it becomes
    the old one, and what is found there is young again. Texts too long to come again are not kept."""

    def __init__(self, encode: Callable[[str], tuple[int, ...]], most: int):
        self.encode, self.half, self.old = encode, max(1, most // 2), {}

    def __missing__(self, text: str) -> tuple[int, ...]:
        found = self.old.get(text)
        if found is None:
            found = self.encode(text)
        if len(text) <= 64:
            self.keep(text, found)
        return found

    def keep(self, text, found: tuple[int, ...]) -> None:
        if len(self) >= self.half:
            self.old = dict(self)
            self.clear()
        self[text] = found


class BulkMerge:
    """The merges of many short byte strings at once: a row a string, a round a merge in every row that has one."""

    def __init__(self, ranks: dict[bytes, int]):
        pairs = [(ranks[t[:i]] << 32 | ranks[t[i:]], rank) for t, rank in ranks.items() for i in range(1, len(t))
                 if t[:i] in ranks and t[i:] in ranks]
        found = np.array(sorted(pairs), dtype=np.int64).reshape(-1, 2)
        self.none = np.int64(1 << 31)
        self.keys = np.append(found[:, 0], np.iinfo(np.int64).max)
        self.ranks = np.append(found[:, 1], self.none)
        self.single = np.array([ranks.get(bytes([i]), 0) for i in range(256)], dtype=np.int64)

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        at = np.searchsorted(self.keys, key)
        return np.where((self.keys[at] == key) & (left >= 0) & (right >= 0), self.ranks[at], self.none)

    def __call__(self, strings: list[bytes], most: int = 1 << 14) -> Iterator[tuple[bytes, tuple[int, ...]]]:
        strings.sort(key=len)
        for lo in range(0, len(strings), most):
            part = strings[lo:lo + most]
            width = len(part[-1])
            raw = np.frombuffer(b"".join(x.ljust(width, b"\0") for x in part), dtype=np.uint8).reshape(-1, width)
            size = np.fromiter(map(len, part), dtype=np.int64, count=len(part))
            ids = np.where(np.arange(width) < size[:, None], self.single[raw], -1)     # -1: past the end
            pair = self.rank_of(ids[:, :-1], ids[:, 1:])
            done = np.full_like(ids, -1)
            rows = np.arange(len(part))
            column = np.arange(width)
            while len(rows):
                at = pair.argmin(axis=1)                 # the leftmost of the lowest
                best = pair[np.arange(len(at)), at]
                live = best < self.none
                done[rows[~live]] = ids[~live]
                rows, ids, pair, at, best = rows[live], ids[live], pair[live], at[live], best[live]
                if not len(rows):
                    break
                here = np.arange(len(rows))
                ids = np.take_along_axis(ids, np.minimum(column + (column > at[:, None]), width - 1), axis=1)
                ids[:, -1] = -1                          # a merge always frees the last place
                ids[here, at] = best
                pair = np.take_along_axis(pair, np.minimum(column[:-1] + (column[:-1] > at[:, None]), width - 2), axis=1)
                pair[:, -1] = self.none
                nxt = np.minimum(at + 1, width - 1)
                pair[here, np.minimum(at, width - 2)] = np.where(
                    at < width - 1, self.rank_of(ids[here, np.minimum(at, width - 2)], ids[here, nxt]), self.none)
                some = at > 0
                pair[here[some], at[some] - 1] = self.rank_of(ids[here[some], at[some] - 1], best[some])
            for data, row, n in zip(part, done.tolist(), (done >= 0).sum(axis=1).tolist()):
                yield data, tuple(row[:n])


class ByteBpe:
    """Encoder and decoder for one set of ranks and one pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, cache_pieces: int = CACHE_PIECES):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.pattern = regex.compile(pattern)
        self._none = len(ranks) + max(ranks.values(), default=0)
        self._loose = re.compile(r"\s (?:\s|\Z)").search   # a space that need not be a cut
        self._pieces = _Cache(self.encode_piece, cache_pieces // 8)
        self._spans = _Cache(lambda span: self._span(" " + span), cache_pieces)
        self._leaf = _Cache(self._merge, cache_pieces // 8)
        self._half = lru_cache(maxsize=1 << 15)(self.encode_bytes)
        self.decimal = {rank: str(rank) for rank in ranks.values()}
        self._pair = lru_cache(maxsize=1 << 17)(self._merge_pair)

    # -- tokens of one piece ---------------------------------------------------------------------
    def _merge(self, data: bytes) -> tuple[int, ...]:
        """Lowest-rank pair first, leftmost on ties, until no pair has a rank."""
        if len(data) > LONG_BYTES:
            return self._merge_long(data)
        rank_of, none, tokens = self.ranks.get, self._none, self.tokens
        parts = [data[i:i + 1] for i in range(len(data))]
        pairs = [rank_of(data[i:i + 2], none) for i in range(len(data) - 1)]
        while pairs:
            best = min(pairs)
            if best == none:
                break
            at = pairs.index(best)
            merged = tokens[best]
            parts[at:at + 2] = [merged]
            del pairs[at]
            if at:
                pairs[at - 1] = rank_of(parts[at - 1] + merged, none)
            if at < len(pairs):
                pairs[at] = rank_of(merged + parts[at + 1], none)
        return tuple([self.ranks[p] for p in parts])

    def _merge_long(self, data: bytes) -> tuple[int, ...]:
        """The same merges in n log n steps: a heap of (rank, place) over a linked list of parts."""
        rank_of, n = self.ranks.get, len(data)
        parts: list[bytes | None] = [data[i:i + 1] for i in range(n)]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i) for i in range(n - 1) if (r := rank_of(data[i:i + 2])) is not None]
        heapify(heap)
        while heap:
            rank, i = heappop(heap)
            j = after[i]
            if parts[i] is None or j >= n or rank_of(parts[i] + parts[j]) != rank:
                continue                                    # one of the two has been merged since
            parts[i], parts[j] = self.tokens[rank], None
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (r := rank_of(parts[i] + parts[k])) is not None:
                    heappush(heap, (r, i))
            if (h := before[i]) >= 0 and (r := rank_of(parts[h] + parts[i])) is not None:
                heappush(heap, (r, h))
        return tuple([self.ranks[p] for p in parts if p is not None])

    def _merge_pair(self, left: int, right: int) -> tuple[int, ...]:
        return self._merge(self.tokens[left] + self.tokens[right])

    def _stable(self, left: int, right: int) -> bool:
        return self._pair(left, right) == (left, right)

    def join_tokens(self, left: tuple[int, ...], right: tuple[int, ...]) -> tuple[int, ...]:
        """The encoding of two neighbouring byte strings' concatenation, from their encodings."""
        if not left or not right:
            return left + right
        window = self._pair(left[-1], right[0])
        if window == (left[-1], right[0]):
            return left + right
        reach = 1
        while True:
            a, b = max(0, len(left) - reach), min(len(right), reach)
            if reach > 1:
                window = self.encode_bytes(b"".join(map(self.tokens.__getitem__, left[a:] + right[:b])), split=False)
            if ((a == 0 or self._stable(left[a - 1], window[0]))
                    and (b == len(right) or self._stable(window[-1], right[b]))):
                return left[:a] + window + right[b:]
            reach *= 2

    def encode_bytes(self, data: bytes, split: bool = True, known: dict | None = None) -> tuple[int, ...]:
        """Tokens of one piece, by halves if it is long.

        The left half is the largest power of two below the length, so that blocks that repeat in a long piece are
        the same blocks; ``known`` holds their encodings while the piece is worked on.
        """
        if len(data) <= LEAF_BYTES or not split:
            return self._leaf[data]
        if len(data) <= 64:
            half = (len(data) + 1) // 2
            return self.join_tokens(self._half(data[:half]), self._half(data[half:]))
        known = {} if known is None else known
        found = known.get(data)
        if found is None:
            half = 1 << ((len(data) - 1).bit_length() - 1)
            found = known[data] = self.join_tokens(self.encode_bytes(data[:half], True, known),
                                                   self.encode_bytes(data[half:], True, known))
        return found

    def encode_piece(self, piece: str) -> tuple[int, ...]:
        data = piece.encode("utf-8", "surrogatepass")
        rank = self.ranks.get(data)
        return (rank,) if rank is not None else self.encode_bytes(data)

    @cached_property
    def _bulk(self) -> BulkMerge:
        return BulkMerge(self.ranks)

    def encode_all(self, texts: list[str]) -> Iterator[list[int]]:
        """The ids of each text; the spans that the cache has not are encoded together."""
        spans = [None if self._loose(t) else t.split(" ") for t in texts]
        self._prepare(set(chain.from_iterable([x[1:] for x in spans if x])))
        for text, own in zip(texts, spans):
            yield self._of_pieces(text) if own is None else self._of_spans(own)

    def _prepare(self, spans: set[str]) -> None:
        """Encode the unseen spans of the set, the leaves of their pieces all at once."""
        known, old = self._spans, self._spans.old
        unseen = [x for x in spans if x not in known and x not in old and len(x) <= 64]
        pieces = [self.pattern.findall(" " + x) for x in unseen]
        coded = {x: x.encode("utf-8", "surrogatepass") for x in set(chain.from_iterable(pieces))}
        found, leaves = {}, {}
        for piece, data in coded.items():
            rank = self.ranks.get(data)
            if rank is not None:
                found[piece] = (rank,)
            elif len(data) <= LEAF_BYTES:
                leaves[data] = piece
            else:
                found[piece] = self.encode_bytes(data)
        found.update((leaves[data], ids) for data, ids in self._bulk(list(leaves)))
        for span, own in zip(unseen, pieces):
            known.keep(span, found[own[0]] if len(own) == 1 else tuple(chain.from_iterable([found[x] for x in own])))

    # -- pieces of a text ------------------------------------------------------------------------
    def _join_pieces(self, left: list[str], right: list[str]) -> list[str]:
        """Pieces of two neighbouring spans' concatenation, from their pieces."""
        if not left or not right:
            return left + right
        # A cut at distance >= _LOOKAHEAD before the border, not inside or next to white space that
        # touches the border, is final: everything that decided it lies before the border.
        keep, reach = len(left), 0
        while keep and (reach < _LOOKAHEAD or left[keep][:1].isspace()):
            keep -= 1
            reach += len(left[keep])
        tail = "".join(left[keep:])
        taken = 0
        while True:
            take = min(len(right), max(4, 2 * taken))
            window = self.pattern.findall(tail + "".join(right[:take]))
            cuts, pos = {}, 0
            for i, piece in enumerate(right[:take]):
                cuts[pos] = i
                pos += len(piece)
            at = -len(tail)
            for i, piece in enumerate(window):
                # A cut of the window before its last pieces is a cut of the whole text.
                rest = pos - at
                if at in cuts and (rest > _LOOKAHEAD or take == len(right)) and not (
                        take < len(right) and "".join(window[i:]).isspace()):
                    return left[:keep] + window[:i] + right[cuts[at]:]
                at += len(piece)
            if take == len(right):
                return left[:keep] + window
            taken = take

    def pieces(self, text: str) -> list[str]:
        """The pattern's matches, by tree reduction over spans of ``LEAF_CHARS`` characters."""
        if len(text) <= LEAF_CHARS:
            return self.pattern.findall(text)
        level = [self.pattern.findall(text[i:i + LEAF_CHARS]) for i in range(0, len(text), LEAF_CHARS)]
        while len(level) > 1:
            level = [self._join_pieces(level[i], level[i + 1]) if i + 1 < len(level) else level[i]
                     for i in range(0, len(level), 2)]
        return level[0]

    def _of_pieces(self, text: str) -> list[int]:
        return list(chain.from_iterable(map(self._pieces.__getitem__, self.pieces(text))))

    def _of_spans(self, spans: list[str]) -> list[int]:
        return [*self._span(spans[0]), *chain.from_iterable(map(self._spans.__getitem__, spans[1:]))]

    def encode(self, text: str) -> list[int]:
        return self._of_pieces(text) if self._loose(text) else self._of_spans(text.split(" "))

    def _span(self, text: str) -> tuple[int, ...]:
        return tuple(chain.from_iterable(map(self._pieces.__getitem__, self.pieces(text))))

    def decode(self, ids: list[int]) -> bytes:
        """The ids' bytes, concatenated up the tree of halves; leaves hold ``LEAF_IDS`` tokens."""
        if len(ids) <= LEAF_IDS:
            return b"".join(map(self.tokens.__getitem__, ids))
        half = (len(ids) + 1) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])


_READY: dict[int, ByteBpe] = {}


def _encoder(shared) -> ByteBpe:
    """The task process's encoder for the broadcast ranks, built once a process."""
    if shared.id not in _READY:
        _READY.clear()
        lines, pattern = shared.value
        _READY[shared.id] = ByteBpe(read_ranks(lines), pattern)
    return _READY[shared.id]


class _Shared:
    def __init__(self, broadcast):
        self.broadcast, self.id = broadcast, broadcast._jbroadcast.id()

    def __getstate__(self):
        return self.broadcast, self.id

    def __setstate__(self, state):
        self.broadcast, self.id = state

    @property
    def value(self):
        return self.broadcast.value


def _over_texts(docs: DataFrame, path: str, pattern: str, id_col: str, text_col: str, schema: T.StructType,
                row: Callable[[ByteBpe, object, list[int]], tuple]) -> DataFrame:
    ship(docs.sparkSession)
    with open(path) as file:   # the vocabulary is a file of the driver's machine, of some 800 KB
        shared = _Shared(docs.sparkSession.sparkContext.broadcast((file.read().splitlines(), pattern)))
    names = schema.names

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = _encoder(shared)
        for batch in batches:
            doc_ids, texts = batch["doc_id"].tolist(), [t or "" for t in batch["text"].tolist()]
            rows = []
            gc.disable()      # nothing below makes cycles, and the collector would walk the caches
            try:
                for lo, hi in batched(texts, PREPARED_CHARS):
                    rows += [row(bpe, i, ids) for i, ids in zip(doc_ids[lo:hi], bpe.encode_all(texts[lo:hi]))]
            finally:
                gc.enable()
            yield pd.DataFrame(rows, columns=names)

    return (docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
            .mapInPandas(run, schema))


def encode_documents(docs: DataFrame, path: str, pattern: str, *, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """(doc_id, token_ids): the ids of every whole text."""
    return _over_texts(docs, path, pattern, id_col, text_col,
                       T.StructType().add("doc_id", T.LongType()).add("token_ids", T.ArrayType(T.IntegerType())),
                       lambda bpe, i, ids: (i, ids))


def decode_documents(encoded: DataFrame, path: str, *, id_col: str = "doc_id", ids_col: str = "token_ids") -> DataFrame:
    """(doc_id, data): the bytes that the ids stand for."""
    ship(encoded.sparkSession)
    with open(path) as file:
        shared = _Shared(encoded.sparkSession.sparkContext.broadcast((file.read().splitlines(), "")))

    def run(batches):
        bpe = _encoder(shared)
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"],
                                "data": [bpe.decode(list(x)) if x is not None else b"" for x in batch["ids"]]})

    return (encoded.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(ids_col).alias("ids"))
            .mapInPandas(run, "doc_id bigint, data binary"))


def _digest_row(bpe: ByteBpe, i, ids: list[int]) -> tuple:
    return (i, len(ids), hashlib.sha256(" ".join(map(bpe.decimal.__getitem__, ids)).encode()).hexdigest(),
            hashlib.sha256(bpe.decode(ids)).hexdigest())


def encode_digests(docs: DataFrame, path: str, pattern: str, *, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every whole text, in one pass and without a shuffle."""
    return _over_texts(docs, path, pattern, id_col, text_col,
                       T.StructType().add("doc_id", T.LongType()).add("n_tokens", T.LongType())
                       .add("ids_sha256", T.StringType()).add("decoded_sha256", T.StringType()), _digest_row)
