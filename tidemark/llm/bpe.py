"""Byte-level BPE, encoded and decoded as a tree reduction over monoid elements.

The element is "a byte string with its tokens". Two neighbours are joined by looking at the pair of tokens
that meets at the boundary. A token sequence is the encoding of its bytes exactly if each pair of neighbours
is the encoding of *its* bytes, so the join is done when the pairs at the edges of a re-encoded window are
stable; otherwise the window grows by doubling. A match of the splitting pattern is halved down to short
leaves, which are merged directly; between matches nothing can merge, so their join is concatenation.
Decoding concatenates token bytes up the same kind of tree.
"""

from __future__ import annotations

import base64
import heapq
from functools import lru_cache

import regex
from pyspark.sql import DataFrame

from tidemark.functions.columns import names
from tidemark.llm.rows import map_rows, utf8

#: Longest byte string that is merged directly, without halving.
LEAF = 48
#: Pairs of tokens a task remembers. Bounds memory, not results.
REMEMBERED = 500_000
#: Encoded matches a task remembers: as many as were met last, and as many before them. Bounds memory, not results.
MATCHES = 120_000
#: Texts that are encoded together.
TEXTS = 500
#: Texts with more characters are matched piece by piece instead of as one list.
LONG_TEXT = 4_000_000
#: Above every rank: the pair cannot be merged.
NO_RANK = 1 << 62


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a file with one `base64 rank` pair a line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Codec:
    """Encoder and decoder for one rank table. `split` is the pattern whose matches are encoded one by one."""

    def __init__(self, ranks: dict[bytes, int], split: str):
        self.ranks = ranks
        self.token = {rank: token for token, rank in ranks.items()}
        self.split = regex.compile(split)
        self.stable: dict[tuple[int, int], bool] = {}
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def merge(self, piece: bytes) -> list[int]:
        """Tokens by repeated merging of the leftmost pair of lowest rank."""
        if len(piece) > 4 * LEAF:
            return self.merge_long(piece)
        get, parts = self.ranks.get, [piece[i : i + 1] for i in range(len(piece))]
        pairs = [get(piece[i : i + 2], NO_RANK) for i in range(len(piece) - 1)]
        while pairs:
            lowest = min(pairs)
            if lowest == NO_RANK:
                break
            i = pairs.index(lowest)
            merged = parts[i] = parts[i] + parts.pop(i + 1)
            del pairs[i]
            if i:
                pairs[i - 1] = get(parts[i - 1] + merged, NO_RANK)
            if i < len(pairs):
                pairs[i] = get(merged + parts[i + 1], NO_RANK)
        return [self.ranks[p] for p in parts]

    def merge_long(self, piece: bytes) -> list[int]:
        """The same in n log n steps: a heap of pairs over a linked list of parts."""
        n, get = len(piece), self.ranks.get
        end, before, after = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := get(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            j = after[i] if end[i] else n
            if not end[i] or j >= n or end[j] != stop or end[i] != j:
                continue  # one of the two parts has changed since
            end[i], after[i], end[j] = stop, after[j], 0
            if after[j] < n:
                before[after[j]] = i
            for a in (before[i], i):
                b = after[a] if a >= 0 else n
                if b < n and (r := get(piece[a : end[b]])) is not None:
                    heapq.heappush(heap, (r, a, end[b]))
        out, i = [], 0
        while i < n:
            out.append(self.ranks[piece[i : end[i]]])
            i = after[i]
        return out

    def keeps(self, left: int, right: int) -> bool:
        """Whether the two tokens stay as they are side by side."""
        found = self.stable.get((left, right))
        if found is None:
            found = self.merge(self.token[left] + self.token[right]) == [left, right]
            if len(self.stable) < REMEMBERED:
                self.stable[left, right] = found
        return found

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """Encoding of the joined bytes from the encodings of both sides."""
        a = b = 0
        window: list[int] = []
        while True:
            middle = [*left[len(left) - a - 1 : len(left) - a], *window, *right[b : b + 1]]
            edge = [middle[:2], middle[-2:]]
            loose_left = a < len(left) and not self.keeps(*edge[0]) if len(middle) > 1 else False
            loose_right = b < len(right) and not self.keeps(*edge[1]) if len(middle) > 1 else False
            if not loose_left and not loose_right:
                return left[: len(left) - a] + window + right[b:]
            a = min(len(left), 2 * a + 1) if loose_left or not window else a
            b = min(len(right), 2 * b + 1) if loose_right or not window else b
            window = self.merge(b"".join(self.token[t] for t in [*left[len(left) - a :], *right[:b]]))

    def tree(self, piece: bytes) -> list[int]:
        if len(piece) <= LEAF:
            return self.merge(piece)
        half = len(piece) // 2
        return self.join(self.tree(piece[:half]), self.tree(piece[half:]))

    def encode_match(self, match: str) -> bytes:
        """Ids of one match of the pattern, packed as little-endian unsigned 32-bit integers."""
        packed = self.known.get(match) or self.older.get(match)
        if packed is None:
            piece = match.encode()
            rank = self.ranks.get(piece)
            ids = self.tree(piece) if rank is None else [rank]
            packed = b"".join(i.to_bytes(4, "little") for i in ids)
        if len(match) <= LEAF:
            if len(self.known) >= MATCHES:
                self.known, self.older = {}, self.known
            self.known[match] = packed
        return packed

    def encode(self, text: str) -> bytes:
        """Packed ids of the text."""
        known, new = self.known.get, self.encode_match
        if len(text) <= LONG_TEXT:
            return b"".join([known(m) or new(m) for m in self.split.findall(text)])
        return b"".join(known(m) or new(m) for m in (x.group() for x in self.split.finditer(text)))

    def decode(self, packed: bytes) -> bytes:
        """Bytes of packed ids."""
        ids = memoryview(packed).cast("I").tolist()
        return self._concat(ids, 0, len(ids))

    def _concat(self, ids: list[int], start: int, stop: int) -> bytes:
        if stop - start <= 65_536:
            return b"".join(map(self.token.__getitem__, ids[start:stop]))
        half = (start + stop) // 2
        return self._concat(ids, start, half) + self._concat(ids, half, stop)


@lru_cache(maxsize=2)
def codec(path: str, split: str) -> Codec:
    """One codec for each worker process."""
    return Codec(read_ranks(path), split)


def encode_documents(
    docs: DataFrame, path: str, split: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",), round_trip: bool = False
) -> DataFrame:
    """`keep` columns, then `ids` (packed little-endian unsigned 32-bit) and, if asked for, `decoded` bytes.

    Rows are encoded where they are read; nothing is shuffled. `path` names the rank file, which every worker
    must be able to read. A null text counts as empty and gives no ids. Repeated rows each give a row; columns
    that are not kept play no part, whatever their names. Matches of any length are encoded whole.
    """
    chosen = docs.select(*names(keep), utf8(text).alias("__text"))
    added = "ids binary" + ", decoded binary" * round_trip

    def run(batches):
        own = codec(path, split)
        for *kept, texts in batches:
            ids = [own.encode(t.decode("utf-8", "replace")) for t in texts]
            yield [*kept, ids, *([[own.decode(i) for i in ids]] if round_trip else [])]

    return map_rows(chosen, len(keep), added, run, rows=TEXTS)


def decode_documents(encoded: DataFrame, path: str, split: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """`keep` columns and `decoded` bytes of the packed `ids`; null ids count as none."""
    chosen = encoded.select(*names(keep), utf8("ids").alias("__ids"))

    def run(batches):
        own = codec(path, split)
        for *kept, packed in batches:
            yield [*kept, [own.decode(p) for p in packed]]

    return map_rows(chosen, len(keep), "decoded binary", run)
