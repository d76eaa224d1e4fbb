"""BPE encoding and decoding by a tokenization automaton.

The automaton reads tokens; a text's BPE tokens are the one accepted path that spells it. It starts as one state
with an arc for each byte. Merge ``k`` of (u, v) into w adds a gadget: behind u the arc v is closed; wherever u could be
read with v behind it, w can be read, and what may follow w is what may follow v just then. A state is thus named by
the last token read, and the arc (y, t) follows from the gadgets alone: it is closed if (y, t) was merged, else it
is what the later-born of y and t inherited: (y, left of t) or (right of y, t) as of that token's birth. ``compile``
runs the gadgets in order and drops merges whose own arc had been closed; arcs are looked up in the tables and kept.

A word is encoded left to right: the state after each prefix is the only token that ends there and whose arc from the
state before it is open. Which tokens end at a byte is read from a second table: a trie of the tokens with failure
links moves by (node, byte), a node names the longest token that ends there, a token the next shorter one.
Decoding joins the bytes on the arcs.

Defined results: a null text is the empty text, without tokens; the special tokens' strings in a text are those tokens;
rows are judged one by one, so ties and repeats do not matter; other columns are ignored by the query.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: the byte-level word pattern of this kind of tokenizer (fixed value)
WORD = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
#: words and arcs a worker remembers before it starts over
CACHE = 400_000


def byte_of_char() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary file, turned around."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Automaton:
    """Gadget tables, and the arcs and words met so far. Plain lists and dicts, so that it can be broadcast."""

    def __init__(self, labels: list[bytes], merges: list[tuple[int, int, int]], special: dict[str, int]):
        n = len(labels)
        self.labels, self.special = labels, special
        self.left, self.right, self.born = [-1] * n, [-1] * n, [-1] * n
        self.closed: dict[tuple[int, int], int] = {}
        self.arcs: dict[tuple[int, int], bool] = {}
        self.words: dict[str, tuple[int, ...]] = {}
        made = {t for t, b in enumerate(labels) if len(b) == 1}
        for k, (u, v, w) in enumerate(merges):
            if u in made and v in made and self._open(u, v, k):
                self.closed[u, v] = k
                if w not in made:
                    self.left[w], self.right[w], self.born[w] = u, v, k
                    made.add(w)
        own = set(special.values())
        self.token = {labels[t]: t for t in made if t not in own}
        self.size = [len(b) for b in labels]
        self._recognise()
        self.split = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.word = regex.compile(WORD)

    def _open(self, y: int, t: int, before: int) -> bool:
        """Whether t could be read behind y once the gadgets up to ``before`` were in."""
        left, right, born, closed = self.left, self.right, self.born, self.closed
        while True:
            k = closed.get((y, t))
            if k is not None and k < before:
                return False
            by, bt = born[y], born[t]
            if by < 0 and bt < 0:
                return True
            if y == t:
                before, y, t = by, right[y], left[t]
            elif bt > by:
                before, t = bt + (left[t] == right[t]), left[t]
            else:
                before, y = by, right[y]

    def _recognise(self) -> None:
        """Compiles the table of token ends."""
        self.edge: dict[int, int] = {}  # node << 8 | byte: node of the trie
        parent, spelled, at = [0], [-1], {}
        for label, t in sorted(self.token.items(), key=lambda x: len(x[0])):
            node = 0
            for byte in label:
                key = node << 8 | byte
                nxt = self.edge.get(key)
                if nxt is None:
                    nxt = self.edge[key] = len(spelled)
                    spelled.append(-1)
                    parent.append(key)
                node = nxt
            spelled[node], at[t] = t, node
        depth = [0] * len(spelled)
        for node in range(1, len(spelled)):
            depth[node] = depth[parent[node] >> 8] + 1
        self.fail, self.ends, self.moves = [0] * len(spelled), [-1] * len(spelled), {}
        for node in sorted(range(1, len(spelled)), key=depth.__getitem__):
            above, byte = parent[node] >> 8, parent[node] & 255
            self.fail[node] = self._move(self.fail[above], byte) if above else 0
            self.ends[node] = spelled[node] if spelled[node] >= 0 else self.ends[self.fail[node]]
        self.moves.clear()
        self.shorter = {t: self.ends[self.fail[node]] for t, node in at.items()}

    def _move(self, node: int, byte: int) -> int:
        """The node after one more byte; met moves are kept."""
        start = node
        while True:
            nxt = self.edge.get(node << 8 | byte)
            if nxt is not None or not node:
                break
            node = self.fail[node]
        out = self.moves[start << 8 | byte] = nxt or 0
        return out

    def arc(self, y: int, t: int) -> bool:
        out = self.arcs.get((y, t))
        if out is None:
            if len(self.arcs) >= CACHE:
                self.arcs.clear()
            out = self.arcs[y, t] = self._open(y, t, len(self.born))
        return out

    def encode_word(self, word: bytes) -> tuple[int, ...]:
        """Token ids of one pre-split word."""
        whole = self.token.get(word)
        if whole is not None:
            return (whole,)
        moves, arcs, ends, shorter, size = self.moves, self.arcs, self.ends, self.shorter, self.size
        if len(moves) >= CACHE:
            moves.clear()
        state, node, at = [], 0, 0
        for byte in word:
            key = node << 8 | byte
            node = moves.get(key)
            if node is None:
                node = self._move(key >> 8, byte)
            at += 1
            t = ends[node]
            while size[t] < at:
                y = state[at - size[t] - 1]
                is_open = arcs.get((y, t))
                if is_open or is_open is None and self.arc(y, t):
                    break
                t = shorter[t]
            state.append(t)
        out, end = [], len(word)
        while end:
            out.append(state[end - 1])
            end -= size[state[end - 1]]
        return tuple(reversed(out))

    def _plain(self, text: str) -> Iterator[tuple[int, ...]]:
        words = self.words
        for w in self.word.findall(text):
            ids = words.get(w)
            if ids is None:
                if len(words) >= CACHE:
                    words.clear()
                ids = self.encode_word(w.encode())
                if len(w) <= 64:
                    words[w] = ids
            yield ids

    def encode(self, text: str) -> np.ndarray:
        """Token ids of a text as little-endian 32-bit numbers."""
        parts, at = [], 0
        for m in self.split.finditer(text) if self.split else ():
            parts += [self._plain(text[at:m.start()]), [(self.special[m[0]],)]]
            at = m.end()
        parts.append(self._plain(text[at:]))
        return np.fromiter(chain.from_iterable(chain.from_iterable(parts)), "<u4")

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.labels.__getitem__, ids.tolist())).decode("utf-8", "replace")


def compile_automaton(path: str) -> Automaton:
    """Compiles the merges of a byte-level BPE vocabulary file."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    vocab, byte = spec["model"]["vocab"], byte_of_char()
    special = {x["content"]: x["id"] for x in spec["added_tokens"]}
    labels = [b""] * (max([*vocab.values(), *special.values()]) + 1)
    for text, t in vocab.items():
        labels[t] = bytes(byte[c] for c in text)
    for text, t in special.items():
        labels[t] = text.encode()
    pairs = [p if isinstance(p, list) else p.split(" ") for p in spec["model"]["merges"]]
    return Automaton(labels, [(vocab[u], vocab[v], vocab[u + v]) for u, v in pairs], special)


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, token_ids) of every row.

    The compiled tables are broadcast: their size is fixed by the vocabulary file.
    """
    shared = docs.sparkSession.sparkContext.broadcast(compile_automaton(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = shared.value
        for b in batches:
            for at in range(0, b.num_rows, 256):  # token lists of a few rows at a time
                part = b.slice(at, 256)
                ids = [bpe.encode(x.as_py() or "") for x in part.column("text")]
                flat = np.concatenate(ids).astype(np.int32) if ids else np.zeros(0, np.int32)
                offsets = np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int32)
                yield pa.record_batch([
                    part.column("doc_id"), pa.array(np.diff(offsets).astype(np.int64)),
                    pa.array([hashlib.sha256(x.tobytes()).hexdigest() for x in ids], pa.string()),
                    pa.array([hashlib.sha256(bpe.decode(x).encode()).hexdigest() for x in ids], pa.string()),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                ], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "token_ids"])

    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return keyed.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, token_ids array<int>")
