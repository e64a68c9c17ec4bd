"""Greedy word-piece counts by one linear pass of an automaton over each word.

The trie holds the pieces that may start a word and, below a second root, those that may go on with it. Each
node has a failure link: where the scan stands after the longest pieces of the node's string have been popped;
and the number of pieces popped on the way. Counting follows edges and links and never builds a piece.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import lru_cache

from pyspark.sql import DataFrame

from tidemark.functions.columns import names
from tidemark.llm.bpe import read_ranks
from tidemark.llm.rows import map_rows, utf8

#: Words a task remembers the length of; later new ones are scanned each time. Bounds memory, not results.
REMEMBERED = 300_000
START, GO_ON, NOWHERE = 0, 1, -1


class Automaton:
    """Counts pieces of a word; a word that cannot be cut into pieces counts as one unknown piece."""

    def __init__(self, starts: Iterable[bytes], continuations: Iterable[bytes]):
        self.next: dict[int, int] = {}
        parent, label, piece = [NOWHERE, NOWHERE], [0, 0], [False, False]
        for root, pieces in ((START, starts), (GO_ON, continuations)):
            for token in pieces:
                node = root
                for byte in token:
                    key = node << 8 | byte
                    child = self.next.get(key)
                    if child is None:
                        child = self.next[key] = len(parent)
                        parent.append(node)
                        label.append(byte)
                        piece.append(False)
                    node = child
                piece[node] = node > GO_ON
        self._link(parent, label, piece)

    def _link(self, parent: list[int], label: list[int], piece: list[bool]) -> None:
        depth = [0] * len(parent)
        for node in range(2, len(parent)):  # a parent is always made before its child
            depth[node] = depth[parent[node]] + 1
        self.fail, self.popped = [NOWHERE] * len(parent), [0] * len(parent)
        for node in sorted(range(2, len(parent)), key=depth.__getitem__):
            if piece[node]:
                self.fail[node], self.popped[node] = GO_ON, 1
                continue
            count, at = self.popped[parent[node]], self.fail[parent[node]]
            while at != NOWHERE and at << 8 | label[node] not in self.next:
                count += self.popped[at]
                at = self.fail[at]
            if at != NOWHERE:
                self.fail[node], self.popped[node] = self.next[at << 8 | label[node]], count

    def count(self, word: bytes) -> tuple[int, bool]:
        """Number of pieces, and whether the word could be cut."""
        step, fail, popped = self.next.get, self.fail, self.popped
        node, pieces = START, 0
        for byte in word:
            child = step(node << 8 | byte)
            while child is None:
                pieces += popped[node]
                node = fail[node]
                if node == NOWHERE:
                    return 1, False
                child = step(node << 8 | byte)
            node = child
        while node not in (START, GO_ON):
            pieces += popped[node]
            node = fail[node]
            if node == NOWHERE:
                return 1, False
        return pieces, True


@lru_cache(maxsize=2)
def byte_level(path: str) -> Automaton:
    """From a rank file: tokens with a leading space start words, tokens without one go on with them."""
    tokens = read_ranks(path)
    return Automaton((t for t in tokens if t[:1] == b" "), (t for t in tokens if t[:1] != b" "))


def piece_counts(
    docs: DataFrame, automaton: Callable[[], Automaton], prefix: bytes = b" ", text: str = "text", keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """`keep` columns, `n_words`, `n_pieces`, `n_unknown` (words that cannot be cut; each one piece).

    Words are runs of bytes without ASCII white space, scanned with `prefix` before them. Null and empty texts
    have no words. Rows stay where they are read; repeated rows each give a row; columns not kept play no part.
    """
    chosen = docs.select(*names(keep), utf8(text).alias("__text"))

    def run(batches):
        own, known = automaton(), {}

        def length(word: bytes) -> int:
            pieces, cut = own.count(prefix + word)
            found = pieces if cut else -1
            if len(known) < REMEMBERED and len(word) <= 48:
                known[word] = found
            return found

        for *kept, texts in batches:
            sizes = []
            for t in texts:
                counts = [known.get(w) or length(w) for w in t.split()]
                unknown = counts.count(-1)
                sizes.append((len(counts), sum(counts) + 2 * unknown, unknown))
            yield [*kept, *(list(x) for x in zip(*sizes))]

    return map_rows(chosen, len(keep), "n_words long, n_pieces long, n_unknown long", run)
