"""Token counts by a linear longest-match automaton.

Greedy word pieces (the longest vocabulary entry that starts the rest of a word, again and again)
are counted without building them. The vocabulary's trie gets failure links: where node v can't go
on with the next byte, the pieces at the front of v's string that greedy matching would pop are
already known, so only their number is added and matching goes on from the link's target. Every byte is
read once.

Distinct words of a batch go through the automaton together, one byte position at a time, as numpy
arrays; what is left of them once only a few go on is read byte by byte, so a very long word costs its length. A text's count
is the sum of its words' counts.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache, cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from dyelake.llm.text import NOT_SPACE, by_row, fingerprints, rows_of, texts_of


#: Words that are worth a step of numpy together.
FEW = 32


@dataclass
class Automaton:
    """A trie over bytes; node 0 is the root. edges are node * 256 + byte, sorted, to targets.

    link is the node to go on from if a node has no edge for the next byte, popped the pieces that this
    completes; a node of link -1 can't be split into pieces: its word has no tokenization.
    """

    edges: np.ndarray
    targets: np.ndarray
    link: np.ndarray
    popped: np.ndarray

    @cached_property
    def plain(self) -> tuple[dict, list, list]:
        """edges as a dictionary, link and popped as lists."""
        return dict(zip(self.edges.tolist(), self.targets.tolist(), strict=True)), self.link.tolist(), self.popped.tolist()

    def rest(self, data: bytes, node: int, pieces: int) -> tuple[int, int, bool]:
        """(node, pieces, whether it can't be split) after the bytes, from ``node`` and ``pieces`` on."""
        edges, link, popped = self.plain
        for byte in data:
            to = edges.get(node << 8 | byte)
            while to is None:
                if link[node] < 0:
                    return node, pieces, True
                pieces += popped[node]
                node = link[node]
                to = edges.get(node << 8 | byte)
            node = to
        return node, pieces, False

    def go(self, nodes: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """The targets of the nodes' edges, or -1."""
        key = nodes * 256 + byte
        at = np.minimum(np.searchsorted(self.edges, key), len(self.edges) - 1)
        return np.where(self.edges[at] == key, self.targets[at], -1)

    def count(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, prefix: bytes = b"") -> np.ndarray:
        """Pieces of each byte range with ``prefix`` before it; a word without a tokenization is one."""
        n = len(starts)
        node, pieces, bad = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, bool)
        size = ends - starts
        order = np.argsort(-size, kind="stable")
        live = n
        for step in range(int(size.max(initial=0)) + len(prefix)):
            k = step - len(prefix)
            if k >= 0:
                while live and size[order[live - 1]] <= k:
                    live = int(np.searchsorted(-size[order], -k, "left"))
            own = order[:live]
            own = own[~bad[own]]
            if k >= 0 and len(own) <= FEW:
                for w in own.tolist():
                    node[w], pieces[w], bad[w] = self.rest(data[starts[w] + k : ends[w]].tobytes(), int(node[w]), int(pieces[w]))
                break
            byte = np.full(len(own), prefix[step], np.int64) if k < 0 else data[starts[own] + k].astype(np.int64)
            while len(own):
                to = self.go(node[own], byte)
                done = to >= 0
                node[own[done]] = to[done]
                own, byte = own[~done], byte[~done]
                stuck = self.link[node[own]] < 0
                bad[own[stuck]] = True
                own, byte = own[~stuck], byte[~stuck]
                pieces[own] += self.popped[node[own]]
                node[own] = self.link[node[own]]
        own = np.flatnonzero(~bad & (node > 0))
        while len(own):  # the end of a word: what is left in the automaton falls into pieces
            bad[own[self.link[node[own]] < 0]] = True
            own = own[~bad[own]]
            pieces[own] += self.popped[node[own]]
            node[own] = self.link[node[own]]
            own = own[node[own] > 0]
        return np.where(bad, 1, pieces)


def build(vocabulary: list[bytes]) -> Automaton:
    """The automaton of a vocabulary of byte strings."""
    table: dict[int, int] = {}
    parent, last, word = [0], [0], [False]
    for piece in vocabulary:
        node = 0
        for b in piece:
            key = node << 8 | b
            to = table.get(key)
            if to is None:
                to = table[key] = len(parent)
                parent.append(node)
                last.append(b)
                word.append(False)
            node = to
        if piece:
            word[node] = True
    depth = [0] * len(parent)
    for v in range(1, len(parent)):
        depth[v] = depth[parent[v]] + 1
    link, popped = [-1] * len(parent), [0] * len(parent)
    for v in sorted(range(1, len(parent)), key=depth.__getitem__):
        if word[v]:
            link[v], popped[v] = 0, 1  # the node's whole string is one piece
            continue
        # The parent's pops, until the node before v's last byte can take that byte.
        z, n = link[parent[v]], popped[parent[v]]
        while z >= 0 and (z << 8 | last[v]) not in table:
            n += popped[z]
            z = link[z]
        if z >= 0:
            link[v], popped[v] = table[z << 8 | last[v]], n
    edges = np.fromiter(table.keys(), np.int64, len(table))
    targets = np.fromiter(table.values(), np.int64, len(table))
    order = np.argsort(edges)
    return Automaton(edges[order], targets[order], np.array(link), np.array(popped))


@cache
def _automaton(lines: bytes) -> Automaton:
    return build([base64.b64decode(x.split()[0]) for x in lines.splitlines() if x])


def token_counts(docs: DataFrame, vocabulary: bytes, prefix: bytes = b" ") -> DataFrame:
    """(doc_id, n_words, n_tokens, n_bytes) of each row of ``docs`` (doc_id, text).

    ``vocabulary`` is the content of a file of one base64 piece a line (what follows is ignored), which is sent
    to the tasks: one vocabulary, whatever the corpus. Words are runs of bytes other than ASCII white space; each,
    with ``prefix`` before it, is split greedily into the longest pieces of the vocabulary. A word that
    can't be split so is one token.

    Null and empty texts, and those of white space, count 0. Very long texts and words are read whole.
    Repeated rows are counted one by one; an empty table gives an empty one. Other columns are ignored.
    """
    held = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(held.value)
        for batch in batches:
            for part in rows_of(batch.column("text"), fold=False):
                starts, ends, row = part.spans(NOT_SPACE[part.data])
                _, firsts, which = np.unique(fingerprints(part.data, starts, ends), return_index=True, return_inverse=True)
                pieces = automaton.count(part.data, starts[firsts], ends[firsts], prefix)
                n = len(part)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(part.first, n), pa.array(np.bincount(row, minlength=n)), pa.array(by_row(pieces[which], row, n)), pa.array(np.diff(part.offsets))],
                    names=["doc_id", "n_words", "n_tokens", "n_bytes"],
                )

    return texts_of(docs).mapInArrow(make, "doc_id long, n_words long, n_tokens long, n_bytes long")
