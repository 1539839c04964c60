"""Byte-level BPE encoding and decoding by batched merge rounds over flat numpy arrays.

Texts are cut at added tokens and then by the byte-level pattern, over arrays of code points. Equal
pieces are encoded once: the symbols of all new pieces lie in one flat array, and in every round the
lowest-ranked pair of each piece, found by binary search over sorted pair keys, is merged wherever it
occurs in that piece. Every text is decoded again from its ids.

The same round merges every pair that nothing can come before. Until its turn, a pair (a, b) with x on its
left can only be broken by x itself or by a token that ends in x and takes a, and for that x has to be taken from its
own left first; likewise on the right. The least ranks of such merges are tabled by (x, a) and (b, y); a pair that
ranks below all of them is merged at once. So the rounds of a long piece hardly grow with its length.

Pieces are told apart by a 64-bit hash. Were two different ones to share it, the decoded bytes would
differ from the text; such a chunk is encoded anew with the pieces' bytes as keys.

Defined cases: a null text is empty, an empty text has no ids, rows are independent of each other
(repeated rows repeat), an empty table gives no rows, further columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from recordtrust.llm.text import U64, Texts, byte_values, chunks, span_hash

LETTER, NUMBER, SPACE, OTHER = 0, 1, 2, 3
SHIFT = 20  # ids are below 2**20
NO_RANK = np.int64(1) << 40
LOOK = 8  # symbols on either side that show whether a pair can be merged before its turn
KNOWN_LIMIT = 400_000  # pieces that a worker remembers; beyond it starts anew

OUTPUT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


@cache
def code_point_kinds() -> np.ndarray:
    kinds = np.full(0x110000, OTHER, np.uint8)
    points = np.concatenate([np.arange(0xD800), np.arange(0xE000, 0x110000)])
    everything = points.astype("<u4").tobytes().decode("utf-32-le")
    for pattern, kind in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER), (r"\p{White_Space}+", SPACE)):
        for run in regex.finditer(pattern, everything):
            kinds[points[run.start() : run.end()]] = kind
    return kinds


def piece_starts(points: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Where the byte-level pattern's pieces begin; ``texts`` are the begins of the texts.

    A piece is a contraction ('s 't 're 've 'm 'll 'd), or a run of letters, of numbers or of other
    signs, each with one space before it if there is one, or white space up to that space.
    """
    n = len(points)
    if not n:
        return np.zeros(0, np.int64)
    kind = code_point_kinds()[points]
    first = np.zeros(n + 1, bool)
    first[texts] = True
    first[n] = True
    first = first[:n]
    run = first.copy()
    run[1:] |= kind[1:] != kind[:-1]
    start = run.copy()
    last = np.ones(n, bool)  # last of its run
    last[:-1] = run[1:]
    space = kind == SPACE
    ends_text = np.ones(n, bool)
    ends_text[:-1] = first[1:]
    # The last white space before something else is a piece, or the head of the next one if a blank.
    tail = np.flatnonzero(space & last & ~ends_text)
    start[tail] = True
    joined = tail[points[tail] == 32]
    start[joined + 1] = False
    # Contractions: a lone apostrophe that begins a piece, and one or two letters.
    quote = np.flatnonzero((points == 39) & start & run & last & ~ends_text)
    if len(quote):
        room = np.flatnonzero(first)
        limit = np.append(room[1:], n)[np.searchsorted(room, quote, "right") - 1]
        one = points[np.minimum(quote + 1, n - 1)]
        two = np.where(quote + 2 < limit, points[np.minimum(quote + 2, n - 1)], 0)
        size = np.where(np.isin(one, [ord(c) for c in "stmd"]), 2, 0)
        for a, b in ("re", "ve", "ll"):
            size = np.where((one == ord(a)) & (two == ord(b)), 3, size)
        quote, size = quote[size > 0], size[size > 0]
        start[quote + 1] = False
        after = quote + size
        start[after[after < n]] = True
    return np.flatnonzero(start)


class LeastRanks(NamedTuple):
    """Least rank by pair of tokens, as sorted pair keys."""

    keys: np.ndarray
    ranks: np.ndarray


def least_ranks(left: np.ndarray, right: np.ndarray, merged: np.ndarray, grown_left: bool) -> LeastRanks:
    """Least rank at which a token that ends in x takes a, by (x, a); else that at which b takes one beginning with y, by (b, y)."""
    order = np.argsort(merged, kind="stable")
    made, part = merged[order], (right if grown_left else left)[order]
    grown, fixed, rank = (left, right, np.arange(len(left))) if grown_left else (right, left, np.arange(len(left)))
    keys, ranks = [], []
    while len(grown):
        keys.append((grown << SHIFT) | fixed if grown_left else (fixed << SHIFT) | grown)
        ranks.append(rank)
        # Go on to the outer parts of those tokens, by all merges that make them.
        low, high = np.searchsorted(made, grown), np.searchsorted(made, grown, "right")
        times = high - low
        total = np.cumsum(times)
        which = np.repeat(low - (total - times), times) + np.arange(int(total[-1]))
        grown, fixed, rank = part[which], np.repeat(fixed, times), np.repeat(rank, times)
    key, rank = np.concatenate(keys or [left]), np.concatenate(ranks or [left])
    order = np.lexsort((rank, key))
    distinct, first = np.unique(key[order], return_index=True)
    return LeastRanks(distinct, rank[order][first])


def ranks_of(table: LeastRanks, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    key = (left << SHIFT) | right
    if not len(table.keys):
        return np.full(len(key), NO_RANK)
    at = np.minimum(np.searchsorted(table.keys, key), len(table.keys) - 1)
    return np.where(table.keys[at] == key, table.ranks[at], NO_RANK)


class Vocabulary:
    """Merge table of a tokenizer file as sorted pair keys, and the bytes of every id."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        ids = model["vocab"]
        visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in set(visible)]
        alphabet = {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}
        self.bytes: dict[int, bytes] = {i: bytes(alphabet[c] for c in token) for token, i in ids.items()}
        sign = {b: c for c, b in alphabet.items()}
        self.byte_id = np.array([ids[sign[b]] for b in range(256)], np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left, right = (np.array([ids[p[i]] for p in pairs], np.int64) for i in (0, 1))
        merged = np.array([ids[a + b] for a, b in pairs], np.int64)
        born = dict(zip(merged.tolist(), range(len(pairs)), strict=True))
        # A round may merge all places of a pair at once, as what comes of it only merges later.
        if any(born.get(x, -1) >= rank for side in (left, right) for rank, x in enumerate(side.tolist())):
            raise ValueError("a merge precedes the one that makes its part")
        keys = (left << SHIFT) | right
        order = np.argsort(keys)
        self.keys, self.ranks, self.merged = keys[order], order.astype(np.int64), merged[order]
        self.taken_left = least_ranks(left, right, merged, grown_left=True)
        self.taken_right = least_ranks(left, right, merged, grown_left=False)
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.bytes |= {i: token.encode() for token, i in self.added.items()}
        self.decimal = [str(i) for i in range(max(self.bytes) + 1)]
        self.pattern = regex.compile("|".join(regex.escape(t) for t in sorted(self.added, key=len, reverse=True))) if self.added else None

    def rank(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged id of pairs; NO_RANK where there is no merge."""
        key = (left << SHIFT) | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NO_RANK), self.merged[at]

    def safe(self, symbols: np.ndarray, inner: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """Which pairs rank below all merges that could take one of their parts before them.

        ``inner`` tells which symbols have a next one in their piece, ``rank`` is that of the pair with it.
        ``low[j]`` is a bound from below on the rank at which symbol j can be taken from its left: by its
        neighbour as it is, or by what the neighbour grows to, which first has to be taken from its own left.
        ``high`` is the same from the right. Each step looks one symbol further.
        """
        at = np.flatnonzero(inner)
        by_left, by_right = np.full(len(symbols), NO_RANK), np.full(len(symbols), NO_RANK)
        by_left[at + 1] = ranks_of(self.taken_left, symbols[at], symbols[at + 1])
        by_right[at] = ranks_of(self.taken_right, symbols[at], symbols[at + 1])
        from_left = np.full(len(symbols), NO_RANK)
        from_left[1:] = rank[:-1]
        low, high = np.minimum(from_left, by_left), np.minimum(rank, by_right)
        for _ in range(LOOK):
            low[1:] = np.minimum(from_left[1:], np.maximum(by_left[1:], low[:-1]))
            high[:-1] = np.minimum(rank[:-1], np.maximum(by_right[:-1], high[1:]))
        out = np.zeros(len(symbols), bool)
        # Of equal ranks the left one goes first.
        out[:-1] = (rank[:-1] < NO_RANK) & (rank[:-1] < low[:-1]) & (rank[:-1] <= high[1:])
        return out

    def encode_pieces(self, data: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of many pieces whose bytes lie one after another, and the number of ids of each."""
        symbols, owner = self.byte_id[data], np.repeat(np.arange(len(size)), size)
        done_ids, done_owner = [], []
        while len(symbols):
            inner = owner[1:] == owner[:-1]
            rank = np.full(len(symbols), NO_RANK)
            into = np.zeros(len(symbols), np.int64)
            at = np.flatnonzero(inner)
            rank[at], into[at] = self.rank(symbols[at], symbols[at + 1])
            heads = np.flatnonzero(np.r_[True, ~inner])
            best = np.minimum.reduceat(rank, heads)
            lengths = np.diff(np.append(heads, len(symbols)))
            best_here = np.repeat(best, lengths)
            still = best_here < NO_RANK
            done_ids.append(symbols[~still])
            done_owner.append(owner[~still])
            hit = ((rank == best_here) | self.safe(symbols, np.append(inner, False), rank)) & still
            # Of overlapping places of one pair, every second is merged, from the left.
            again = np.zeros(len(hit), bool)
            again[1:] = hit[1:] & hit[:-1] & inner
            if again.any():
                places = np.arange(len(hit))
                begin = np.maximum.accumulate(np.where(hit & ~again, places, -1))
                hit &= (places - begin) % 2 == 0
            gone = np.zeros(len(hit), bool)
            gone[1:] = hit[:-1]
            symbols = np.where(hit, into, symbols)
            keep = still & ~gone
            symbols, owner = symbols[keep], owner[keep]
        ids, owners = np.concatenate(done_ids or [symbols]), np.concatenate(done_owner or [owner])
        order = np.argsort(owners, kind="stable")
        return ids[order], np.bincount(owners, minlength=len(size))


class Encoder:
    """Encodes chunks of texts; remembers pieces that it has met."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.forget()

    def forget(self) -> None:
        self.known = np.zeros(0, U64)
        self.place, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int64)

    def _learn(self, keys: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> None:
        size = end - start
        total = np.cumsum(size)
        flat = np.repeat(start - (total - size), size) + np.arange(int(total[-1]))
        ids, counts = self.vocabulary.encode_pieces(data[flat], size)
        known = np.concatenate([self.known, keys])
        order = np.argsort(known)
        self.place = np.concatenate([self.place, len(self.ids) + np.cumsum(counts) - counts])[order]
        self.size = np.concatenate([self.size, counts])[order]
        self.known, self.ids = known[order], np.concatenate([self.ids, ids])

    def _ids(self, data: np.ndarray, keys: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        distinct, where, back = np.unique(keys, return_index=True, return_inverse=True)
        if len(self.known) > KNOWN_LIMIT:
            self.forget()
        if len(self.known):
            at = np.minimum(np.searchsorted(self.known, distinct), len(self.known) - 1)
            new = self.known[at] != distinct
        else:
            new = np.ones(len(distinct), bool)
        if new.any():
            self._learn(distinct[new], data, start[where[new]], end[where[new]])
        at = np.searchsorted(self.known, distinct)[back]
        size, place = self.size[at], self.place[at]
        total = np.cumsum(size)
        flat = np.repeat(place - (total - size), size) + np.arange(int(total[-1]) if len(total) else 0)
        return self.ids[flat], size

    def encode(self, texts: Texts, exact: bool = False) -> list[np.ndarray]:
        """Ids of every text, without regard to added tokens. ``exact``: pieces are keyed by their bytes."""
        data, at = texts
        if not len(data):
            return [np.zeros(0, np.int64)] * len(texts)
        lead = np.flatnonzero((data & 0xC0) != 0x80)
        points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        begins = np.searchsorted(lead, at[:-1][np.diff(at) > 0])
        start = lead[piece_starts(points, begins)]
        end = np.append(start[1:], len(data))
        if exact:
            raw = data.tobytes()
            seen: dict[bytes, int] = {}
            keys = np.array([seen.setdefault(raw[a:b], len(seen)) for a, b in zip(start.tolist(), end.tolist(), strict=True)], U64)
            self.forget()
        else:
            keys = span_hash(byte_values(False)[data], start, end)
        ids, size = self._ids(data, keys, start, end)
        if exact:
            self.forget()
        bound = np.concatenate([[0], np.cumsum(size)])[np.searchsorted(start, at)]
        return [ids[a:b] for a, b in zip(bound[:-1].tolist(), bound[1:].tolist(), strict=True)]

    def encode_checked(self, texts: Texts) -> list[np.ndarray]:
        """Ids of every text; added tokens in a text become their ids."""
        raw = texts.data.tobytes()
        added = self.vocabulary.added
        if any(token.encode() in raw for token in added):
            return [self._with_added(raw[a:b]) for a, b in zip(texts.offsets[:-1].tolist(), texts.offsets[1:].tolist(), strict=True)]
        found = self.encode(texts)
        if b"".join(map(self.vocabulary.bytes.__getitem__, np.concatenate(found).tolist() if found else [])) != raw:
            found = self.encode(texts, exact=True)
        return found

    def _with_added(self, raw: bytes) -> np.ndarray:
        text, parts, ids, at = raw.decode("utf-8"), [], [], 0
        for match in self.vocabulary.pattern.finditer(text):
            parts.append(text[at : match.start()].encode())
            ids.append(np.array([self.vocabulary.added[match[0]]], np.int64))
            at = match.end()
        parts.append(text[at:].encode())
        if len(parts) == 1:
            data = np.frombuffer(raw, np.uint8)
            found = self.encode(Texts(data, np.array([0, len(data)])))
            if decode(self.vocabulary, found[0]).encode() != raw:
                found = self.encode(Texts(data, np.array([0, len(data)])), exact=True)
            return found[0]
        out = []
        for part, special in zip(parts, [*ids, None], strict=True):
            out.append(self._with_added(part))
            if special is not None:
                out.append(special)
        return np.concatenate(out)


def decode(vocabulary: Vocabulary, ids: np.ndarray) -> str:
    """Text of ids; bytes that are no UTF-8 become replacement characters."""
    return b"".join(map(vocabulary.bytes.__getitem__, ids.tolist())).decode("utf-8", "replace")


@cache
def encoder(path: str) -> Encoder:
    return Encoder(Vocabulary(path))


def encode_documents(documents: DataFrame, path: str) -> DataFrame:
    """doc_id, ids and the text decoded from them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = encoder(path)
        for batch, texts in chunks(batches):
            ids = one.encode_checked(texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array([decode(one.vocabulary, x) for x in ids], pa.string())],
                names=["doc_id", "ids", "decoded"],
            )

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def encoding_digests(documents: DataFrame, path: str) -> DataFrame:
    """Number of ids, digest of the ids and digest of the decoded text of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = encoder(path)
        decimal = one.vocabulary.decimal.__getitem__
        for batch, texts in chunks(batches):
            ids = one.encode_checked(texts)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(x) for x in ids], pa.int64()),
                    pa.array([hashlib.sha256(",".join(map(decimal, x.tolist())).encode()).hexdigest() for x in ids], pa.string()),
                    pa.array([hashlib.sha256(decode(one.vocabulary, x).encode()).hexdigest() for x in ids], pa.string()),
                ],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return documents.select("doc_id", "text").mapInArrow(run, OUTPUT)
