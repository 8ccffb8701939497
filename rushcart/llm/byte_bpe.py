"""Byte-level BPE encoding by replaying merges over all distinct words at once, and decoding.

A word is a match of the splitting pattern. The distinct words of many texts lie end to
end; an inverted index leads from each merge to the places where a pair asks for it. Ranks
are worked off in order: every place of a rank that still holds the pair is merged, and
only its two neighbours are looked up anew and entered into the index. Words do not
depend on each other, so it does not matter which words are replayed together.

A merge may in principle call for one of a lower rank, which then comes first. Words where
that happens are worked off by themselves, lowest rank first, leftmost among equals.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from rushcart.llm.columns import plain, texts, without_collector

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
#: Bytes of words that are replayed together, about. A longer word is replayed alone.
REPLAY_BYTES = 1 << 18
#: Characters of text whose new words are gathered before a replay.
BLOCK_CHARS = 1 << 22
#: Chunks after which a task forgets what it has encoded.
KEPT = 500_000
#: Longer chunks and words are not kept.
KEPT_CHARS = 64
_NONE, _GONE = -1, -2


class ByteBpe:
    """Ranks of byte strings, as the public files hold them, and the pattern that splits text."""

    def __init__(self, path: str = RANKS, pattern: str = public_tokenizers.PATTERN):
        with open(path, "rb") as file:
            pairs = [line.split() for line in file if line.strip()]
        self.ids = {base64.b64decode(token): int(rank) for token, rank in pairs}
        if any(bytes([b]) not in self.ids for b in range(256)):
            raise ValueError(f"{path}: every byte needs a rank")
        size = max(self.ids.values()) + 1
        self.back, self.decimal = [b""] * size, [str(i).encode() for i in range(size)]
        for token, rank in self.ids.items():
            self.back[rank] = token
        self.single = np.array([self.ids[bytes([b])] for b in range(256)], np.int32)
        none: dict[int, int] = {}
        #: What a rank makes with the rank right (left) of it.
        self.with_right, self.with_left = [none] * size, [none] * size
        for token, rank in self.ids.items():
            for cut in range(1, len(token)):
                a, b = self.ids.get(token[:cut]), self.ids.get(token[cut:])
                if a is not None and b is not None:
                    for table, own, other in ((self.with_right, a, b), (self.with_left, b, a)):
                        if table[own] is none:
                            table[own] = {}
                        table[own][other] = rank
        self.bytes_made = np.full((256, 256), _NONE, np.int32)
        for token, rank in self.ids.items():
            if len(token) == 2:
                self.bytes_made[token[0], token[1]] = rank
        self.match = regex.compile(pattern)
        self.cut = regex.compile(r" (?=\S)")  # a word begins at every such space
        self.uneven = regex.compile(r" \s")
        self.words: dict[str, bytes] = {}
        self.kept: dict[str, bytes] = {}  # ids of chunks, a chunk being what follows such a space

    def replay(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word, as 32-bit numbers end to end."""
        out: list[bytes] = []
        first = size = 0
        for i, word in enumerate(words):
            if size and size + len(word) > REPLAY_BYTES:
                out += self._replay(words[first:i])
                first, size = i, 0
            size += len(word) + 1
        return out + self._replay(words[first:])

    def _index(self, data: np.ndarray, ends: np.ndarray) -> tuple[list, list]:
        """The rank that each place's pair makes, and for each rank its places in order."""
        asked = np.full(len(data), _NONE, np.int32)
        asked[:-1] = self.bytes_made[data[:-1], data[1:]]
        asked[ends] = asked[ends - 1] = _NONE  # words are one apart
        places = np.flatnonzero(asked >= 0)
        places = places[np.argsort(asked[places], kind="stable")]
        ranks, begin = np.unique(asked[places], return_index=True)
        index: list[list | None] = [None] * len(self.back)
        for rank, part in zip(ranks.tolist(), np.split(places, begin[1:])):
            index[rank] = part.tolist()
        return asked.tolist(), index

    def _replay(self, words: list[bytes]) -> list[bytes]:
        if not words:
            return []
        data = np.frombuffer(b"\0".join(words) + b"\0", np.uint8)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes + 1) - 1
        asked, index = self._index(data, ends)
        held = self.single[data]
        held[ends] = _NONE
        tokens = held.tolist()
        tokens.append(_NONE)
        after = list(range(1, len(data) + 2))
        before = list(range(-1, len(data)))
        odd = []
        for rank in range(len(index)):
            places = index[rank]
            if places is None:
                continue
            index[rank] = None
            places.sort()
            with_right, with_left = self.with_right[rank].get, self.with_left[rank].get
            for at in places:
                if asked[at] != rank:
                    continue  # one of the two has been merged meanwhile
                gone = after[at]
                right = after[gone]
                tokens[at], tokens[gone], asked[gone] = rank, _GONE, _NONE
                after[at] = right
                before[right] = at
                left = before[at]
                if (other := tokens[left]) >= 0:
                    asked[left] = new = with_left(other, _NONE)
                    if new > rank:
                        if (there := index[new]) is None:
                            index[new] = [left]
                        else:
                            there.append(left)
                    elif new >= 0:
                        odd.append(at)
                if (other := tokens[right]) >= 0:
                    asked[at] = new = with_right(other, _NONE)
                    if new > rank:
                        if (there := index[new]) is None:
                            index[new] = [at]
                        else:
                            there.append(at)
                    elif new >= 0:
                        odd.append(at)
                else:
                    asked[at] = _NONE
        flat = np.array(tokens[:-1], np.int32)
        real = np.flatnonzero(flat >= 0)
        stops = (4 * np.searchsorted(real, ends)).tolist()
        ids = flat[real].tobytes()
        out = [ids[a:b] for a, b in zip([0, *stops], stops)]
        for word in np.unique(np.searchsorted(ends, odd)).tolist() if odd else ():
            out[word] = self.alone(words[word])
        return out

    def alone(self, word: bytes) -> bytes:
        """Ids of one word: the lowest rank first, the leftmost of equals."""
        tokens: list[int] = self.single[np.frombuffer(word, np.uint8)].tolist()
        after, before = list(range(1, len(word) + 1)), list(range(-1, len(word) - 1))
        agenda: list[tuple[int, int, int, int]] = []

        def offer(a: int, b: int) -> None:
            if a >= 0 and b < len(word) and (rank := self.with_right[tokens[a]].get(tokens[b])) is not None:
                heapq.heappush(agenda, (rank, a, b, after[b]))

        for at in range(len(word) - 1):
            offer(at, at + 1)
        while agenda:
            rank, a, b, end = heapq.heappop(agenda)
            if tokens[a] < 0 or after[a] != b or after[b] != end or self.with_right[tokens[a]].get(tokens[b]) != rank:
                continue
            tokens[a], tokens[b], after[a] = rank, _NONE, end
            if end < len(word):
                before[end] = a
            offer(before[a], a)
            offer(a, end)
        return np.array([t for t in tokens if t >= 0], np.int32).tobytes()

    def chunks(self, text: str) -> list[str]:
        """The text cut before every space that a visible character follows, those spaces left
        out. The pattern begins a word there, whatever stands around it."""
        return self.cut.split(text) if self.uneven.search(text) else text.split(" ")

    def learn(self, chunks: list[str]) -> list[bytes]:
        """Ids of pieces of text; words that are not known yet are replayed together."""
        split = list(map(self.match.findall, chunks))
        known = self.words
        new = list(set(chain.from_iterable(split)).difference(known))
        found, spelled = {}, []
        for word in new:
            if (whole := self.ids.get(coded := word.encode())) is None:
                spelled.append((word, coded))
            else:
                found[word] = np.int32(whole).tobytes()  # a word of the vocabulary needs no merges
        found.update(zip([w for w, _ in spelled], self.replay([coded for _, coded in spelled])))
        known.update((w, ids) for w, ids in found.items() if len(w) <= KEPT_CHARS)
        found = {w: ids for w, ids in found.items() if len(w) > KEPT_CHARS}
        return [known[w[0]] if len(w) == 1 and w[0] in known else b"".join([known[x] if x in known else found[x] for x in w]) for w in split]

    def encode_all(self, rows: list[str]) -> list[np.ndarray]:
        """Ids of whole texts."""
        out: list[np.ndarray] = []
        block: list[str] = []
        size = 0
        for text in rows:
            block.append(text)
            size += len(text)
            if size >= BLOCK_CHARS:
                out += self._block(block)
                block, size = [], 0
        return out + self._block(block)

    def _block(self, rows: list[str]) -> list[np.ndarray]:
        if len(self.kept) > KEPT:
            self.kept, self.words = {}, {}
        cut = [self.chunks(text) for text in rows]
        first = self.learn([chunks[0] for chunks in cut])
        missing: set[str] = set()
        for chunks in cut:
            missing.update(chunks[1:])
        new = list(missing.difference(self.kept))
        long = {}
        for chunk, ids in zip(new, self.learn([" " + chunk for chunk in new])):
            (self.kept if len(chunk) <= KEPT_CHARS else long)[chunk] = ids
        kept, out = self.kept, []
        for ids, chunks in zip(first, cut):
            try:
                parts = [kept[c] for c in chunks[1:]]
            except KeyError:
                parts = [kept[c] if c in kept else long[c] for c in chunks[1:]]
            out.append(np.frombuffer(ids + b"".join(parts), np.int32))
        return out

    def encode(self, text: str) -> list[int]:
        return self.encode_all([text])[0].tolist()

    def decoded(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.back.__getitem__, ids))


def _encoded(model: ByteBpe, column: pa.Array) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Ids of a column's texts in runs of rows, with the first row of each run."""
    rows = texts(column)
    first = size = 0
    for row, text in enumerate(rows, 1):
        size += len(text)
        if size >= BLOCK_CHARS or row == len(rows):
            with without_collector():
                ids = model.encode_all(rows[first:row])
            yield first, ids
            first, size = row, 0


def encode_bytes(docs: DataFrame, path: str = RANKS) -> DataFrame:
    """Per row: (doc_id, ids). Null text counts as empty and has no ids.

    Only ``doc_id`` and ``text`` are read; equal rows have equal ids, no rows give none. Texts
    of any length are encoded whole, a word without a border in one piece. Strings that
    look like special tokens are ordinary text. The rank file must be readable at ``path``
    on every machine; it is loaded once per task.
    """

    def run(batches):
        model = ByteBpe(path)
        for batch in batches:
            for first, ids in _encoded(model, batch.column("text")):
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(first, len(ids)), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return plain(docs, "doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>")


def decode_bytes(encoded: DataFrame, path: str = RANKS) -> DataFrame:
    """Per row: (doc_id, text), from (doc_id, ids). Null ids count as none; where ids cut a
    character, what is no UTF-8 becomes U+FFFD."""

    def run(batches):
        model = ByteBpe(path)
        for batch in batches:
            rows = [model.decoded(x or ()).decode("utf-8", "replace") for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def byte_digests(docs: DataFrame, path: str = RANKS) -> DataFrame:
    """Per row: (doc_id, n_tokens, ids_sha256, decoded_sha256), the last of the bytes that the
    ids decode to. ``ids_sha256`` hashes the decimal ids joined by one space. Rows as in
    :func:`encode_bytes`."""

    def run(batches):
        model = ByteBpe(path)
        decimal = model.decimal.__getitem__
        for batch in batches:
            for first, rows in _encoded(model, batch.column("text")):
                lists = [x.tolist() for x in rows]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(first, len(rows)),
                        pa.array([len(x) for x in rows], pa.int64()),
                        pa.array([hashlib.sha256(b" ".join(map(decimal, ids))).hexdigest() for ids in lists], pa.string()),
                        pa.array([hashlib.sha256(model.decoded(ids)).hexdigest() for ids in lists], pa.string()),
                    ],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return plain(docs, "doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
