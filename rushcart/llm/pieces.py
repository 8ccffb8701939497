"""SentencePiece BPE encoding with seeded merge-dropout, and decoding.

Merges are worked off an agenda, best score first and leftmost among equals. With
dropout, each candidate merge that comes up is skipped for good with a chance that a
keyed hash decides, so one seed always gives one segmentation. Text is cut before
every run of word marks: no piece of the vocabulary reaches across such a border
(checked when the model is loaded), so pieces of a chunk do not depend on its
neighbours. The hash is keyed by the document and the place in it, too, so every
occurrence of a chunk is decided for itself. Each chunk has a tree of decisions: a node
holds the merges that come up when a certain few are skipped, and what they end in. An
occurrence goes on from the first of them that its own hash skips to the node below, and
has arrived where it skips none; only merges that really come up are hashed.
"""

from __future__ import annotations

import gc
import hashlib
import heapq
import re
from contextlib import contextmanager
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from rushcart.llm.columns import plain, texts

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "\u2581"
#: Marks that begin a chunk, or its text.
CHUNK = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
#: Stands for a word mark of the text itself; no real chunk looks like it.
OWN_MARK = f"!{MARK}"
#: Longer chunks are worked off one by one and not kept.
KEPT_CHARS = 32
#: Segmentations that a task keeps, about.
KEPT_CHUNKS = 300_000
#: Occurrences that skip more merges are worked off one by one and not kept.
KEPT_SKIPS = 6
#: Chunks that are looked up together.
BLOCK = 150_000
_NONE = np.int32(2**31 - 1)
#: In a row of pieces: beyond its end, and from where on characters that are no piece stand, downwards.
_PAST, _UNKNOWN = -3, -10
_MIX = (1 << 64) - 1


class _Powers(list):
    """Multipliers of a chunk's characters, by place; long chunks make the list longer."""

    def __getitem__(self, j):
        while len(self) <= j:
            self.append(list.__getitem__(self, -1) * 0x9FB21C651E98DF25 & _MIX)
        return list.__getitem__(self, j)


_POWERS = _Powers([1])


def _stir(x):
    """Mixes 64 bits; of a Python int or of a numpy array alike."""
    whole = _MIX if isinstance(x, int) else np.uint64(_MIX)
    x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 & whole
    x = (x ^ (x >> 27)) * 0x94D049BB133111EB & whole
    return x ^ (x >> 31)


class _Grown:
    """A numpy array that grows at its end."""

    def __init__(self, kind):
        self.held, self.size = np.zeros(1024, kind), 0

    def add(self, values: np.ndarray) -> None:
        size = self.size + len(values)
        if size > len(self.held):
            self.held = np.concatenate([self.held[: self.size], np.zeros(2 * size - self.size, self.held.dtype)])
        self.held[self.size : size] = values
        self.size = size

    @property
    def all(self) -> np.ndarray:
        return self.held[: self.size]


class _Lists:
    """Many short lists of numbers, end to end."""

    def __init__(self, kind):
        self.flat, self.begin, self.count = _Grown(kind), _Grown(np.int64), _Grown(np.int64)

    def add(self, flat: np.ndarray, count: np.ndarray) -> None:
        self.begin.add(self.flat.size + np.cumsum(count) - count)
        self.count.add(count)
        self.flat.add(flat)


def _members(begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Where the members of lists stand, one list after the other."""
    last = np.cumsum(count)
    return np.arange(int(last[-1]) if len(last) else 0) + np.repeat(begin - last + count, count)


def _in_order(owners, flats, counts, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Lists that come in parts, each with its owners, in the order of the owners 0 to n - 1."""
    owner, flat, count = (np.concatenate(x) for x in (owners, flats, counts))
    begin, size = np.zeros((2, n), np.int64)
    begin[owner], size[owner] = np.cumsum(count) - count, count
    return flat[_members(begin, size)], size


def _place(a, b, end) -> np.ndarray:
    return a.astype(np.uint64) << np.uint64(42) | b.astype(np.uint64) << np.uint64(21) | end.astype(np.uint64)


class Pieces:
    """A merge-type SentencePiece vocabulary with byte pieces."""

    def __init__(self, path: str = MODEL, dropout: float = 0.0, seed: int = 0):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        special = [model.is_control(i) or model.is_unknown(i) or model.is_byte(i) for i in range(len(names))]
        self.ids = {name: i for i, name in enumerate(names) if not special[i]}
        self.bytes = {int(name[3:5], 16): i for i, name in enumerate(names) if model.is_byte(i)}
        if len(self.bytes) < 256 or any(MARK in name.lstrip(MARK) for name in self.ids):
            raise ValueError(f"{path}: needs byte pieces and word marks only at the beginning of pieces")
        self.back = [
            bytes([int(name[3:5], 16)]) if model.is_byte(i) else name.replace(MARK, " ").encode()
            for i, name in enumerate(names)
        ]
        by_score = sorted(self.ids.values(), key=lambda i: (-model.get_score(i), i))
        self.rank = np.full(len(names), _NONE, np.int32)
        self.rank[by_score] = np.arange(len(by_score))
        self.ranked = np.array(by_score, np.int32)
        self.single = np.array([self.ids.get(chr(c), _UNKNOWN - c) for c in range(1 << 14)], np.int32)
        self._index_pairs()
        self.limit = min(int(dropout * 2**64), _MIX)
        self.seed, self.variants = seed, 1 << 64 if dropout else 1
        self._forget()

    def _index_pairs(self) -> None:
        """A hash table in numpy from two piece ids to the id of what they make."""
        pairs = [
            (self.ids[name[:cut]] << 32 | self.ids[name[cut:]], i)
            for name, i in self.ids.items()
            for cut in range(1, len(name))
            if name[:cut] in self.ids and name[cut:] in self.ids
        ]
        keys, made = (np.array(x, np.int64) for x in zip(*pairs))
        self.bits = max(10, int(8 * len(keys)).bit_length())
        self.pair_key, self.pair_made = np.full(1 << self.bits, -1, np.int64), np.full(1 << self.bits, -1, np.int32)
        self.probes, rest = 0, np.arange(len(keys))
        while len(rest):
            slot = self._slot(keys[rest], self.probes)
            free = np.flatnonzero(self.pair_key[slot] < 0)
            _, first = np.unique(slot[free], return_index=True)
            placed = free[first]
            self.pair_key[slot[placed]], self.pair_made[slot[placed]] = keys[rest[placed]], made[rest[placed]]
            rest = np.delete(rest, placed)
            self.probes += 1

    def _slot(self, keys: np.ndarray, probe: int) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return ((mixed >> np.uint64(64 - self.bits)).astype(np.int64) + probe) & ((1 << self.bits) - 1)

    def _made(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ids of what pairs of pieces make, -1 for nothing."""
        keys = left.astype(np.int64) << 32 | right
        keys[(left < 0) | (right < 0)] = -2
        slot = self._slot(keys, 0)
        found = np.where(self.pair_key[slot] == keys, self.pair_made[slot], np.int32(-1))
        open_ = np.flatnonzero((self.pair_key[slot] != keys) & (self.pair_key[slot] >= 0))
        for probe in range(1, self.probes):
            if not len(open_):
                break
            slot = self._slot(keys[open_], probe)
            hit = self.pair_key[slot] == keys[open_]
            found[open_[hit]] = self.pair_made[slot[hit]]
            open_ = open_[~hit & (self.pair_key[slot] >= 0)]
        return found

    def _forget(self) -> None:
        self.roots: dict[str, int] = {}  # the node of each chunk where nothing is skipped
        self.words: list[str] = []
        self.word, self.total = _Grown(np.int64), _Grown(np.uint64)  # a node's chunk, and that chunk's part of the key
        self.above, self.skip = _Grown(np.int64), _Grown(np.uint64)  # the node above, and the merge skipped on the way from there
        self.ways, self.ends = _Lists(np.uint64), _Lists(np.int32)  # the merges that come up, and the ids in the end
        self.turns, self.lead = np.zeros(0, np.int64), np.zeros(0, np.int64)  # sorted: node and merge skipped; the node below
        self.roots[OWN_MARK] = 0  # goes as bytes, whatever is skipped
        self.words.append(OWN_MARK)
        own = [self.bytes[b] for b in MARK.encode()]
        self._keep([0], [0], [-1], [0], [], [0], own, [len(own)])

    def _keep(self, word, total, above, skip, way, steps, ids, count) -> None:
        for held, values in ((self.word, word), (self.total, total), (self.above, above), (self.skip, skip)):
            held.add(values)
        self.ways.add(way, steps)
        self.ends.add(ids, count)

    def _grow(self, new: list[str], above: np.ndarray | None = None, skip: np.ndarray | None = None) -> np.ndarray:
        """Adds the roots of new chunks, or else the nodes below others; their numbers."""
        begin = self.word.size
        if above is None:
            word = np.arange(len(self.words), len(self.words) + len(new))
            self.roots |= dict(zip(new, range(begin, begin + len(new))))
            self.words += new
            above, skip = np.full(len(new), -1), np.zeros(len(new), np.uint64)
            skipped = np.zeros((len(new), 0), np.uint64)
        else:
            word, columns, at = self.word.all[above], [skip], above
            while ((up := self.above.all[at]) >= 0).any():
                columns.append(self.skip.all[at])
                at = np.where(up >= 0, up, at)  # a root stays, where nothing is skipped
            skipped = np.stack(columns, axis=1)
        ids, count, way, steps, total = self._learn([self.words[i] for i in word.tolist()], skipped=skipped)
        self._keep(word, total, above, skip, way, steps, ids, count)
        return np.arange(begin, begin + len(word))

    def _key(self, chunk: str, variant: int) -> int:
        total = sum((ord(char) + 1) * _POWERS[j] for j, char in enumerate(chunk))
        return _stir((_stir(((self.seed * 0x9E3779B97F4A7C15 & _MIX) + variant) & _MIX) + total) & _MIX)

    def chunk(self, chunk: str, variant: int) -> list[int]:
        """Ids of one chunk, merged off an agenda; what ends as no piece goes as bytes."""
        size, key = len(chunk), self._key(chunk, variant)
        ends, before, agenda = list(range(1, size + 1)), list(range(-1, size - 1)), []

        def offer(a: int, b: int) -> None:
            if a >= 0 and b < size and (i := self.ids.get(chunk[a : ends[b]])) is not None:
                heapq.heappush(agenda, (int(self.rank[i]), a, b, ends[b]))

        for at in range(size - 1):
            offer(at, at + 1)
        while agenda:
            _, a, b, end = heapq.heappop(agenda)
            if ends[a] != b or ends[b] != end:
                continue  # one of the two has been merged meanwhile
            if self.limit and _stir(key ^ _stir(a << 42 | b << 21 | end)) < self.limit:
                continue
            ends[a], ends[b] = end, -1
            if end < size:
                before[end] = a
            offer(before[a], a)
            offer(a, end)
        ids, at = [], 0
        while at < size:
            part = chunk[at : ends[at]]
            known = self.ids.get(part)
            ids += [known] if known is not None else [self.bytes[b] for b in part.encode("utf-8", "surrogatepass")]
            at = ends[at]
        return ids

    def _offer(self, agenda, pieces, after, keys, skipped, size, row, a, b) -> None:
        """Puts the rank of merging the pieces that begin at ``a`` and ``b`` of the given rows on
        the agenda, _NONE where there is no such merge or it is skipped."""
        begin = row * size
        left, right = begin + a, begin + b
        made = self._made(pieces.take(left), pieces.take(right))
        ranks = np.full(len(row), _NONE)
        can = np.flatnonzero(made >= 0)
        ranks[can] = self.rank.take(made.take(can))
        if self.limit and (skipped is None or skipped.shape[1]):
            row = row.take(can)
            place = _stir(_place(a.take(can), b.take(can), after.take(right.take(can))))
            if skipped is None:
                out = _stir(keys.take(row) ^ place) < np.uint64(self.limit)
            else:
                out = (skipped.take(row, axis=0) == place[:, None]).any(axis=1)
            ranks[can[out]] = _NONE
        agenda[left] = ranks

    def chunks(self, chunks: list[str], variants: list[int]) -> list[bytes]:
        """The same for many chunks at once."""
        ids, count, *_ = self._rounds(chunks, np.array(variants, np.uint64), None)
        flat, cut = ids.tobytes(), np.cumsum(4 * count).tolist()
        return [flat[a:b] for a, b in zip([0, *cut], cut)]

    def _rounds(self, chunks: list[str], variants: np.ndarray | None, skipped: np.ndarray | None):
        """Many chunks at once: in every round each row takes the best merge of its agenda. What is skipped,
        the variants' hashes say, or else the given lists of (stirred) merges.

        A row holds its pieces where they begin, and for each the beginnings before and after.
        Returned end to end are ids and their number per chunk, the (stirred) merges in their order and
        theirs, and the chunks' parts of the key.
        """
        sizes = np.array([len(c) for c in chunks])
        size = int(sizes.max())
        joined = np.frombuffer("".join(chunks).encode("utf-32-le", "surrogatepass"), np.uint32)
        inside = np.arange(size) < sizes[:, None]
        pieces = np.full(inside.shape, _PAST, np.int32)
        single = self.single[np.minimum(joined, len(self.single) - 1)]
        rare = np.flatnonzero(joined >= len(self.single))
        single[rare] = [self.ids.get(chr(c), _UNKNOWN - c) for c in joined[rare].tolist()]
        pieces[inside] = single
        places = np.array([_POWERS[j] for j in range(size)], np.uint64)
        weighed = np.zeros(inside.shape, np.uint64)
        weighed[inside] = joined.astype(np.uint64) + np.uint64(1)
        total = (weighed * places).sum(axis=1)
        keys = total if variants is None else self._keys(variants, total)
        skipped_ = np.zeros((len(chunks), 0), np.uint64) if skipped is None else skipped
        after = np.broadcast_to(np.arange(1, size + 1, dtype=np.int32), inside.shape).copy()
        before = np.broadcast_to(np.arange(-1, size - 1, dtype=np.int32), inside.shape).copy()
        agenda = np.full(pieces.shape, _NONE)
        row, at = np.nonzero(inside[:, 1:])
        self._offer(agenda.reshape(-1), pieces.reshape(-1), after.reshape(-1), keys, skipped, size, row, at, at + 1)
        rows = np.arange(len(chunks))  # all that goes on is kept together in the arrays below
        done_rows, done_ids, done_count, taken_rows, taken = [], [], [], [], []
        state = [rows, pieces, after, before, keys, skipped_, agenda, sizes]
        while len(state[0]):
            rows, pieces, after, before, keys, skipped_, agenda, ends = state
            best = agenda.argmin(axis=1)
            begin = np.arange(len(rows)) * size
            flat, flat_after, flat_before, flat_agenda = (x.reshape(-1) for x in (pieces, after, before, agenda))
            rank = flat_agenda.take(begin + best)
            lane = np.flatnonzero(rank != _NONE)
            if len(lane) < 0.7 * len(rows) or not len(lane):
                over = rank == _NONE
                done = pieces[over]
                real = done != _PAST
                done_rows.append(rows[over])
                done_ids.append(done[real])
                done_count.append(real.sum(axis=1))
                state = [x.take(lane, axis=0) for x in state]
                continue
            begin, a = begin.take(lane), best.take(lane)
            at = begin + a
            b = flat_after.take(at)
            to = begin + b
            c, d = flat_after.take(to), flat_before.take(at)
            if skipped is not None and self.limit:
                taken_rows.append(rows.take(lane))
                taken.append(_place(a, b, c))
            flat[at], flat[to] = self.ranked.take(rank.take(lane)), _PAST
            flat_after[at] = c
            flat_agenda[at] = flat_agenda[to] = _NONE
            right, left = np.flatnonzero(c < ends.take(lane)), np.flatnonzero(d >= 0)
            flat_before[(begin + c).take(right)] = a.take(right)
            self._offer(
                flat_agenda, flat, flat_after, keys, None if skipped is None else skipped_, size,
                lane.take(np.concatenate([right, left])),
                np.concatenate([a.take(right), d.take(left)]),
                np.concatenate([c.take(right), a.take(left)]),
            )
        ids, count = self._as_bytes(*_in_order(done_rows, done_ids, done_count, len(chunks)))
        none = np.zeros(0, np.uint64)
        owner = np.concatenate([*taken_rows, none.astype(np.int64)])
        way = _stir(np.concatenate([*taken, none])[np.argsort(owner, kind="stable")])
        return ids, count, way, np.bincount(owner, minlength=len(chunks)), total

    def _as_bytes(self, ids: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What ended as no piece goes as bytes."""
        unknown = np.flatnonzero(ids <= _UNKNOWN)
        if not len(unknown):
            return ids, count
        chars, which = np.unique(ids[unknown], return_inverse=True)
        coded = [chr(_UNKNOWN - c).encode("utf-8", "surrogatepass") for c in chars.tolist()]
        width = np.ones(len(ids), np.int64)
        width[unknown] = np.array([len(x) for x in coded])[which]
        begin = np.cumsum(width) - width
        wide = np.repeat(ids, width)
        for n in range(4):
            has = np.array([len(x) > n for x in coded])[which]
            wide[begin[unknown[has]] + n] = np.array([self.bytes[x[n]] if len(x) > n else 0 for x in coded], np.int32)[which[has]]
        owner = np.repeat(np.arange(len(count)), count)
        return wide, np.bincount(owner, weights=width, minlength=len(count)).astype(np.int64)

    def _learn(self, chunks: list[str], variants: np.ndarray | None = None, skipped: np.ndarray | None = None):
        """What _rounds gives, from rows of like length together."""
        sizes = np.fromiter(map(len, chunks), np.int64, len(chunks))
        order = np.argsort(sizes, kind="stable")
        sizes, a, parts = sizes[order], 0, []
        while a < len(order):
            b = int(np.searchsorted(sizes, max(4, sizes[a] * 4 // 3), side="right"))
            own = order[a:b]
            keyed = None if variants is None else variants[own], None if skipped is None else skipped[own]
            parts.append((own, *self._rounds([chunks[i] for i in own.tolist()], *keyed)))
            a = b
        own, ids, count, way, steps, total = zip(*parts)
        sums = np.empty(len(chunks), np.uint64)
        sums[np.concatenate(own)] = np.concatenate(total)
        return *_in_order(own, ids, count, len(chunks)), *_in_order(own, way, steps, len(chunks)), sums

    def _keys(self, variants: np.ndarray, total: np.ndarray) -> np.ndarray:
        return _stir(_stir(np.uint64(self.seed * 0x9E3779B97F4A7C15 & _MIX) + variants) + total)

    def _places(self, document: int, first: int, count: int) -> np.ndarray:
        """What keys the skips at ``count`` places of a document, from its place ``first``."""
        if self.variants == 1:
            return np.zeros(count, np.uint64)
        begin = _stir((document * 0x2545F4914F6CDD1D + self.seed) & _MIX)
        return _stir(np.arange(first, first + count, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(begin))

    def encode_all(self, rows: list[str], documents: list[int]) -> list[np.ndarray]:
        """Ids of whole texts. A word mark that a text itself holds goes as bytes, so nothing is lost."""
        out: list[list[np.ndarray]] = [[] for _ in rows]
        block: list[tuple[int, np.ndarray, list[str]]] = []
        waiting = 0
        for row, text in enumerate(rows):
            first = 0
            for chunks in _blocks(text):
                block.append((row, self._places(documents[row], first, len(chunks)), chunks))
                first, waiting = first + len(chunks), waiting + len(chunks)
                if waiting >= BLOCK:
                    self._flush(block, out)
                    block, waiting = [], 0
        self._flush(block, out)
        return [np.concatenate([np.zeros(0, np.int32), *parts]) for parts in out]

    def _flush(self, block, out) -> None:
        if not block:
            return
        if self.word.size > KEPT_CHUNKS:
            self._forget()
        chunks = list(chain.from_iterable(own for _, _, own in block))
        variants = np.concatenate([places for _, places, _ in block])
        node = self._arrive(chunks, variants)
        held, count, begin = self.ends.flat.all, self.ends.count.all[node], self.ends.begin.all[node]
        if len(alone := np.flatnonzero(node < 0)):
            ids, count[alone] = self._alone([chunks[i] for i in alone.tolist()], variants[alone])
            begin[alone] = len(held) + np.cumsum(count[alone]) - count[alone]
            held = np.concatenate([held, ids])
        flat, cut, at = held[_members(begin, count)], [0, *np.cumsum(count).tolist()], 0
        for row, _, own in block:
            out[row].append(flat[cut[at] : cut[at + len(own)]])
            at += len(own)

    def _arrive(self, chunks: list[str], variants: np.ndarray) -> np.ndarray:
        """The node in which each occurrence skips no more; -1 for one that is to be worked off alone."""
        get = self.roots.get
        node = np.array([get(c, -1) for c in chunks], np.int64)
        open_ = np.flatnonzero(node < 0).tolist()
        if new := list(dict.fromkeys(c for i in open_ if len(c := chunks[i]) <= KEPT_CHARS)):
            self._grow(new)
            node[open_] = [get(chunks[i], -1) for i in open_]
        live = np.flatnonzero(node >= 0) if self.limit else np.zeros(0, np.int64)
        keys = self._keys(variants[live], self.total.all[node[live]])
        for skips in range(KEPT_SKIPS + 1):
            count = self.ways.count.all[node[live]]
            way = self.ways.flat.all[_members(self.ways.begin.all[node[live]], count)]
            hit = np.flatnonzero(_stir(np.repeat(keys, count) ^ way) < np.uint64(self.limit))
            owner = np.repeat(np.arange(len(live)), count)[hit]
            first = np.flatnonzero(np.diff(owner, prepend=-1))
            owner, hit = owner[first], hit[first]
            step = hit - (np.cumsum(count) - count)[owner]
            live, keys = live[owner], keys[owner]
            if not len(live):
                break
            node[live] = self._below(node[live], step, way[hit]) if skips < KEPT_SKIPS else -1
        return node

    def _below(self, node: np.ndarray, step: np.ndarray, skip: np.ndarray) -> np.ndarray:
        """The nodes to which skipping the given merges leads."""
        key = node * KEPT_CHARS + step
        at = np.searchsorted(self.turns, key)
        open_ = np.flatnonzero(np.append(self.turns, -1)[at] != key)
        if len(open_):
            missing, first = np.unique(key[open_], return_index=True)
            numbers = self._grow([], node[open_[first]], skip[open_[first]])
            turns = np.concatenate([self.turns, missing])
            order = np.argsort(turns, kind="stable")
            self.turns, self.lead = turns[order], np.concatenate([self.lead, numbers])[order]
        return self.lead[np.searchsorted(self.turns, key)]

    def _alone(self, chunks: list[str], variants: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids, end to end, and their numbers of chunks that are not kept."""
        sizes = np.array([len(c) for c in chunks])
        short, long = np.flatnonzero(sizes <= KEPT_CHARS), np.flatnonzero(sizes > KEPT_CHARS).tolist()
        parts = [([i], np.array(ids, np.int32), [len(ids)]) for i in long for ids in [self.chunk(chunks[i], int(variants[i]))]]
        if len(short):
            parts.append((short, *self._learn([chunks[i] for i in short.tolist()], variants[short])[:2]))
        return _in_order(*zip(*parts), len(chunks))

    def encode(self, text: str, document: int = 0) -> list[int]:
        return self.encode_all([text], [document])[0].tolist()

    def decode(self, ids) -> str:
        """The text that was encoded, character for character."""
        return self.decoded(ids).decode("utf-8", "surrogatepass")

    def decoded(self, ids) -> bytes:
        back = self.back
        return b"".join([back[i] for i in ids])[1:]


def _marked(text: str):
    """Chunks of a text, which begins with a mark that it does not have itself."""
    for n, part in enumerate(text.split(MARK)) if text else ():
        if n:
            yield OWN_MARK
        marked = part.replace(" ", MARK)
        for found in CHUNK.finditer(marked if n else MARK + marked):
            yield found.group()


def _blocks(text: str):
    """The same in lists of BLOCK at most."""
    if text and len(text) < BLOCK and MARK not in text:
        yield CHUNK.findall(MARK + text.replace(" ", MARK))
        return
    chunks = _marked(text)
    while block := list(islice(chunks, BLOCK)):
        yield block


@contextmanager
def _without_collector():
    """Encoding makes no reference cycles, and Python's collector would walk all that is kept again and again."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


def encode_pieces(docs: DataFrame, path: str = MODEL, dropout: float = 0.1, seed: int = 0) -> DataFrame:
    """Per row: (doc_id, ids). Null text counts as empty and has no ids; repeated rows are encoded alike,
    texts of any length whole, and no rows give no rows.

    Only ``doc_id`` and ``text`` are read. The model file must be readable at ``path`` on
    every machine; it is loaded once per task.
    """

    def run(batches):
        model = Pieces(path, dropout, seed)
        for batch in batches:
            rows = texts(batch.column("text"))
            keys = batch.column("doc_id").to_pylist()
            for a in range(0, len(rows), 500):
                with _without_collector():
                    ids = model.encode_all(rows[a : a + 500], [k or 0 for k in keys[a : a + 500]])
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, 500), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return plain(docs, "doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>")


def decode_pieces(encoded: DataFrame, path: str = MODEL) -> DataFrame:
    """Per row: (doc_id, text), from (doc_id, ids). Null ids count as none; no rows give no rows."""

    def run(batches):
        model = Pieces(path)
        for batch in batches:
            rows = batch.column("ids").to_pylist()
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([model.decode(x or []) for x in rows], pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def piece_digests(docs: DataFrame, path: str = MODEL, dropout: float = 0.1, seed: int = 0) -> DataFrame:
    """Per row: (doc_id, n_pieces, ids_sha256, text_sha256), the last read back from the ids.

    ``ids_sha256`` hashes the ids as 32-bit little-endian numbers. Rows as in :func:`encode_pieces`.
    """

    def run(batches):
        model = Pieces(path, dropout, seed)
        for batch in batches:
            rows, keys = texts(batch.column("text")), batch.column("doc_id").to_pylist()
            for a in range(0, len(rows), 500):
                with _without_collector():
                    ids = model.encode_all(rows[a : a + 500], [k or 0 for k in keys[a : a + 500]])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(a, 500),
                        pa.array([len(x) for x in ids], pa.int64()),
                        pa.array([hashlib.sha256(x.tobytes()).hexdigest() for x in ids], pa.string()),
                        pa.array([hashlib.sha256(model.decoded(x.tolist())).hexdigest() for x in ids], pa.string()),
                    ],
                    ["doc_id", "n_pieces", "ids_sha256", "text_sha256"],
                )

    return plain(docs, "doc_id", "text").mapInArrow(run, "doc_id long, n_pieces long, ids_sha256 string, text_sha256 string")
