"""Removal of byte strings that stand earlier in the corpus, by a hash-compared suffix sort.

Every 100-byte window has an anchor, the place of its smallest 24-byte hash, which depends
on the window's bytes alone: equal windows have equal anchors at equal offsets. So windows
need to be compared only where anchors agree.

1. Anchors meet by hash. One that stands once in the corpus has no equal windows.
2. The others' surroundings (all windows of the anchor, a *segment*) are sent to the anchor.
   There they are suffix-sorted: two suffixes are compared by binary search over prefix
   hashes for their longest common extension, then by the byte after it. What the hashes
   call equal is compared byte by byte before it counts.
3. Of equal segments all but the earliest are removed. Segments that are equal in part only
   are compared window by window, again in suffix order.
4. The documents get the starts of their removed windows back.

A task sends equal segments once, so a passage of very many documents stays small.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from rushcart.llm.columns import partitions, pieces, plain, utf8
from rushcart.llm.shingles import powers, stir
from rushcart.sources.folders import stored

LENGTH = 100
GRAM = 24
_BASE = 0xD1342543DE82EF95
_INVERSE = pow(_BASE, -1, 1 << 64)
_LOW = np.uint64((1 << 40) - 1)
_WORDS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))
#: Anchors that one task gets, about, and bytes of segments. Each task has several buckets, which evens out tasks.
PER_TASK = 1_500_000
TASK_BYTES = 8 << 20
BUCKETS = 4
#: Anchors, and bytes of segments, that leave a task together.
FLUSH_ANCHORS = 400_000
FLUSH_BYTES = 6 << 20
#: Bytes of segments that are compared at a time, and windows; an anchor's are never parted.
COMPARED_BYTES, COMPARED_WINDOWS = 2 << 20, 300_000
#: A longer row's windows are looked through in parts.
LONG = 1 << 20
#: Anchors in so many flushes are spread over buckets, the SPLIT_MOST most frequent at most; the others stay
#: together, which changes no result.
SPLIT_FROM, SPLIT_MOST = 20_000, 500_000
#: Bits of the filter that spares documents without a match the shuffle; its size is fixed.
FILTER_BITS = 23


class Hashes:
    """Prefix polynomial hashes of strings that stand end to end, of the lengths given. Exponents
    count from the beginning of a string, so no table is longer than the longest one."""

    def __init__(self, data: np.ndarray, lengths: np.ndarray):
        self.data = data
        size = 1 << max(8, int(lengths.max(initial=0) + 1).bit_length())
        self.inverse = powers(_INVERSE, size)
        self.place = np.arange(len(data), dtype=np.int32) - np.repeat(np.cumsum(lengths) - lengths, lengths).astype(np.int32)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(_BASE, size)[self.place], out=self.sums[1:])

    def of(self, at: np.ndarray, length) -> np.ndarray:
        """Of the parts of a string that begin ``at``."""
        return (self.sums[at + length] - self.sums[at]) * self.inverse[self.place[at]]

    def extension(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How many bytes the strings at ``a`` and ``b`` share from their beginning, ``most`` at most."""
        low, high = np.zeros(len(a), np.int64), most.copy()
        while (open_ := low < high).any():
            middle = (low + high + 1) // 2
            same = self.of(a, middle) == self.of(b, middle)
            low = np.where(open_ & same, middle, low)
            high = np.where(open_ & ~same, middle - 1, high)
        return low

    def same_bytes(self, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Compares byte by byte, whatever the hashes say."""
        out = np.ones(len(a), bool)
        for at in range(0, len(a), 20_000):
            x, y, n = (v[at : at + 20_000] for v in (a, b, length))
            if len(x):
                step = np.arange(int(n.max()))
                inside = step < n[:, None]
                last = len(self.data) - 1
                differ = self.data[np.minimum(x[:, None] + step, last)] != self.data[np.minimum(y[:, None] + step, last)]
                out[at : at + 20_000] = ~(differ & inside).any(axis=1)
        return out


def suffix_order(hashes: Hashes, group: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by group and then by the strings, and per place whether it equals the one before.

    A mergesort from the bottom up, over all groups at once: each element finds its rank in
    the run beside its own by binary search, a comparison costing one search for the common
    extension. Lengths are equal within a group.
    """
    order = np.argsort(group, kind="stable")
    if len(order) == 0:
        return order, np.zeros(0, bool)
    sorted_group = group[order]
    begin = np.flatnonzero(np.append(True, sorted_group[1:] != sorted_group[:-1]))
    sizes = np.diff(np.append(begin, len(order)))
    base = np.repeat(begin, sizes)
    size = np.repeat(sizes, sizes)
    place = np.arange(len(order)) - base
    width, most = 1, int(sizes.max())
    while width < most:
        at = np.flatnonzero(size > width)
        own = place[at] // width
        beside = base[at] + (own ^ 1) * width
        beside_size = np.clip(size[at] - (own ^ 1) * width, 0, width)
        low, high = np.zeros(len(at), np.int64), beside_size
        element, left = order[at], own % 2 == 0
        while (open_ := np.flatnonzero(low < high)).size:
            middle = (low[open_] + high[open_]) // 2
            other = order[beside[open_] + middle]
            before = _less(hashes, start[other], start[element[open_]], length[element[open_]], left[open_])
            low[open_] = np.where(before, middle + 1, low[open_])
            high[open_] = np.where(before, high[open_], middle)
        target = base[at] + (own // 2) * 2 * width + place[at] % width + low
        order[target] = element
        width *= 2
    equal = np.zeros(len(order), bool)
    pair = np.flatnonzero(sorted_group[1:] == sorted_group[:-1])
    a, b = order[pair], order[pair + 1]
    close = hashes.of(start[a], length[a]) == hashes.of(start[b], length[b])
    a, b, pair = a[close], b[close], pair[close]
    right = hashes.same_bytes(start[a], start[b], length[a])
    equal[pair[right] + 1] = True
    for g in np.unique(group[a[~right]]):  # a collision: this group goes by its bytes alone
        at = np.flatnonzero(sorted_group == g)
        string = {i: hashes.data[start[i] : start[i] + length[i]].tobytes() for i in order[at].tolist()}
        order[at] = sorted(string, key=string.get)
        equal[at[1:]] = [string[x] == string[y] for x, y in zip(order[at].tolist(), order[at[1:]].tolist())]
    return order, equal


def _less(hashes: Hashes, a: np.ndarray, b: np.ndarray, length: np.ndarray, strict: np.ndarray) -> np.ndarray:
    """Whether the string at ``a`` comes before that at ``b``; equal ones do unless ``strict``."""
    out = ~strict
    first, second = hashes.data[a], hashes.data[b]
    out[first != second] = (first < second)[first != second]
    rest = np.flatnonzero(first == second)
    shared = hashes.extension(a[rest], b[rest], length[rest])
    differ = shared < length[rest]
    at = rest[differ]
    out[at] = hashes.data[a[at] + shared[differ]] < hashes.data[b[at] + shared[differ]]
    return out


def later_equals(hashes, group, start, length, doc, place) -> np.ndarray:
    """Which strings equal an earlier one of their group, earlier by document and place.

    Strings that share both (a repeated row) are not earlier than one another.
    """
    order, equal = suffix_order(hashes, group, start, length)
    kind = np.cumsum(~equal)
    by = np.lexsort((place[order], doc[order], kind))
    kind, doc, place = kind[by], doc[order][by], place[order][by]
    head = np.flatnonzero(np.append(True, kind[1:] != kind[:-1])) if len(kind) else np.zeros(0, np.int64)
    first = np.repeat(head, np.diff(np.append(head, len(kind))))
    out = np.zeros(len(kind), bool)
    out[order[by]] = (doc != doc[first]) | (place != place[first])
    return out


def anchors(data: np.ndarray, starts: np.ndarray) -> dict[str, np.ndarray]:
    """The anchors of all windows: row, first and last window start, place and hash of the anchor."""
    n, span = len(data), LENGTH - GRAM + 1
    if len(starts) == 2 and n - LENGTH + 1 > LONG:  # one long row: its windows in parts; an anchor at a cut has two segments then
        parts = []
        for a in range(0, n - LENGTH + 1, LONG):
            cut = data[a : a + LONG + LENGTH - 1]
            found = anchors(cut, np.array([0, len(cut)]))
            parts.append({c: v + a if c in ("first", "last", "at") else v for c, v in found.items()})
        return {c: np.concatenate([p[c] for p in parts]) for c in parts[0]}
    names = ("row", "first", "last", "at", "hash")
    if n < LENGTH:
        return {c: np.zeros(0, np.uint64 if c == "hash" else np.int64) for c in names}
    # A gram's hash, from the three 8-byte words that it consists of.
    words = np.ndarray((n - 7,), np.uint64, np.ascontiguousarray(data), strides=(1,)).copy()
    gram = stir(words[:-16] * _WORDS[0] + words[8:-8] * _WORDS[1] + words[16:] * _WORDS[2])
    del words
    blocks = np.full(-(-len(gram) // span) * span, np.uint64(2**64 - 1))
    blocks[: len(gram)] = gram
    blocks = blocks.reshape(-1, span)
    upto = np.minimum.accumulate(blocks, axis=1).ravel()
    since = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    count = n - LENGTH + 1
    least = np.minimum(since[:count], upto[span - 1 : span - 1 + count])
    fresh = np.ones(count, bool)  # the smallest hash is another one, or the leftmost place of it has just been left
    np.not_equal(least[1:], least[:-1], out=fresh[1:])
    fresh[1:] |= gram[: count - 1] == least[:-1]
    fresh[starts[:-1][starts[:-1] < count]] = True
    first = np.flatnonzero(fresh)
    row = np.searchsorted(starts, first, side="right") - 1
    ends = np.append(first, count)[1:]
    keep = first + LENGTH <= starts[row + 1]
    first, row, ends = first[keep], row[keep], ends[keep]
    last = np.minimum(ends, starts[row + 1] - LENGTH + 1) - 1
    smallest = least[first]
    # A hash below the window before is new and stands last; else the leftmost place is searched for, as the
    # hash that comes in may stand further left, too.
    at = first + span - 1
    old = np.flatnonzero((first == starts[row]) | (least[np.maximum(first - 1, 0)] <= smallest))
    for a in range(0, len(old), 20_000):
        i = old[a : a + 20_000]
        at[i] = first[i] + (gram[first[i][:, None] + np.arange(span)] == smallest[i][:, None]).argmax(axis=1)
    return {"row": row, "first": first, "last": last, "at": at, "hash": smallest}


def _bucket(hashed: np.ndarray, buckets: int) -> np.ndarray:
    return ((hashed >> np.uint64(40)) * np.uint64(buckets) >> np.uint64(24)).astype(np.int64)


def _shelf(doc: np.ndarray, version: np.ndarray, shelves: int) -> np.ndarray:
    """Of a document. Copies of a text have one version; their ids spread them over all shelves."""
    return (stir(doc.view(np.uint64) ^ stir(version.view(np.uint64))) % np.uint64(shelves)).astype(np.int64)


def _cuts(values: np.ndarray) -> list[int]:
    return [0, *(np.flatnonzero(values[1:] != values[:-1]) + 1).tolist(), len(values)] if len(values) else [0]


def _packed(key: np.ndarray, **columns: np.ndarray) -> pa.RecordBatch:
    """One row per key, the other columns packed as bytes."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    cuts = _cuts(key)
    sorted_ = [c[order] for c in columns.values()]
    packed = [pa.array([c[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary()) for c in sorted_]
    return pa.RecordBatch.from_arrays([pa.array(key[cuts[:-1]], pa.int64()), *packed], ["key", *columns])


def _groups(batches):
    """Rows of a partition that is sorted by ``key``, key by key."""
    now, rows = None, []
    for batch in batches:
        for a in range(0, batch.num_rows, 32):  # rows are large
            for row in batch.slice(a, 32).to_pylist():
                if rows and row["key"] != now:
                    yield now, rows
                    rows = []
                now = row["key"]
                rows.append(row)
    if rows:
        yield now, rows


def _joined(rows: list[dict], **kinds) -> dict[str, np.ndarray]:
    return {c: np.frombuffer(b"".join(r[c] for r in rows), kind) for c, kind in kinds.items()}


SENT = "key long, low binary, high binary, doc binary, version binary, at binary"


def _sent(buckets: int):
    """Anchors packed by bucket. Those that repeat within a task's flush are settled there: one
    place is sent for the others' sake, the rest goes on as repeated under keys below 0."""

    def flushed(held):
        doc, version, at, hashed = (np.concatenate(x) for x in zip(*held))
        _, first, inverse, count = np.unique(hashed, return_index=True, return_inverse=True, return_counts=True)
        key = _bucket(hashed, buckets)
        known = count[inverse] > 1
        rest = known.copy()
        rest[first] = False
        key = np.where(rest, -1 - _shelf(doc, version, buckets), key)
        # Of a repeated anchor the place that is sent carries a mark in its highest byte.
        low = hashed & _LOW
        return _packed(
            key,
            low=low.astype(np.uint32),
            high=(low >> np.uint64(32)).astype(np.uint8),
            doc=doc,
            version=version,
            at=(at << 1 | known).astype(np.int64),
        )

    def run(batches):
        held, size = [], 0
        for batch in batches:
            data, starts = utf8(batch.column("text"))
            doc, version = (batch.column(c).to_numpy() for c in ("doc", "version"))
            for a, b in pieces(starts):
                found = anchors(data[starts[a] : starts[b]], starts[a : b + 1] - starts[a])
                row = found["row"]
                held.append((doc[a:b][row], version[a:b][row], found["at"] - (starts[a:b] - starts[a])[row], found["hash"]))
                size += len(row)
                if size >= FLUSH_ANCHORS:
                    yield flushed(held)
                    held, size = [], 0
        if size:
            yield flushed(held)

    return run


PLACES = "key long, doc binary, version binary, at binary"
#: Under this key stand anchors that many tasks have, by name and number of places.
OFTEN = -1


def _name(bucket, hashed: np.ndarray) -> np.ndarray:
    return (np.uint64(1 << 40) * np.asarray(bucket, np.uint64) | hashed & _LOW).view(np.int64)


def _repeated(shelves: int, split_from: int):
    """The places of anchors that stand more than once, packed by the shelf of their document."""

    def run(batches):
        for key, rows in _groups(batches):
            found = _joined(rows, low=np.uint32, high=np.uint8, doc=np.int64, version=np.int64, at=np.int64)
            keep = np.ones(len(found["low"]), bool)
            if key >= 0:
                hashed = found["low"].astype(np.uint64) | found["high"].astype(np.uint64) << np.uint64(32)
                order = np.argsort(hashed)
                hashed = hashed[order]
                same = np.zeros(len(hashed) + 1, bool)
                same[1:-1] = hashed[1:] == hashed[:-1]
                keep[order] = same[1:] | same[:-1]
                head = np.flatnonzero(~same[:-1])
                count = np.diff(np.append(head, len(hashed)))
                if (count >= split_from).any():
                    often, count = _name(key, hashed[head[count >= split_from]]), count[count >= split_from]
                    yield _packed(np.full(len(often), OFTEN), doc=often, version=count, at=count)
                keep |= (found["at"] & 1).astype(bool)
            if keep.any():
                doc, version, at = (found[c][keep] for c in ("doc", "version", "at"))
                yield _packed(_shelf(doc, version, shelves), doc=doc, version=version, at=at >> 1)

    return run


def _per_document(batches):
    """From shelves, one row per document with its places in order; without places, one per frequent anchor."""
    for key, rows in _groups(batches):
        found = _joined(rows, doc=np.int64, version=np.int64, at=np.int64)
        if key == OFTEN:
            often = [pa.array(found["doc"]), pa.array(found["version"]), pa.nulls(len(found["doc"]), pa.binary())]
            yield pa.RecordBatch.from_arrays(often, ["doc", "version", "places"])
            continue
        order = np.lexsort((found["at"], found["version"], found["doc"]))
        doc, version, at = (found[c][order] for c in ("doc", "version", "at"))
        cuts = sorted({*_cuts(doc), *_cuts(version)})
        for a in range(0, len(cuts) - 1, 2000):
            part = cuts[a : a + 2001]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(doc[part[:-1]]),
                    pa.array(version[part[:-1]]),
                    pa.array([at[x:y].tobytes() for x, y in zip(part, part[1:])], pa.binary()),
                ],
                ["doc", "version", "places"],
            )


SEGMENTS = "key long, low binary, high binary, offset binary, length binary, doc binary, version binary, start binary, bytes binary"


def _strings(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Strings end to end, and where each begins."""
    begin = np.cumsum(length) - length
    total = int(length.sum())
    at = np.repeat(start - begin, length) + np.arange(total)
    return data[at], begin


def _segments(buckets: int, often: np.ndarray, named_by: int):
    """Segments of repeated anchors packed by bucket; of equal ones in a flush the earliest, while
    the window starts of the others go on as removed, under keys below 0.

    Around an anchor that very many documents have, segments differ at the passage's ends. They
    are sent window by window, each to the bucket of its own bytes, so no bucket gets them all.
    """

    def flushed(held):
        data = np.concatenate([h["data"] for h in held])
        shift = np.cumsum([0, *(len(h["data"]) for h in held)])
        found = {c: np.concatenate([h[c] for h in held]) for c in held[0] if c not in ("data", "begin")}
        begin = np.concatenate([h["begin"] + s for h, s in zip(held, shift)])
        hashes = Hashes(data, found["length"])
        _, group = np.unique(
            stir(found["hash"] ^ stir((found["offset"] << 20 | found["length"]).astype(np.uint64))), return_inverse=True
        )
        gone = later_equals(hashes, group, begin, found["length"], found["doc"], found["start"])
        if gone.any():
            n = int(gone.sum())
            empty = {c: np.zeros(n, np.uint8) for c in ("low", "high")}
            removed = _packed(
                -1 - _shelf(found["doc"][gone], found["version"][gone], buckets), **empty,
                offset=found["offset"][gone].astype(np.uint8), length=found["length"][gone].astype(np.uint8),
                doc=found["doc"][gone], version=found["version"][gone], start=found["start"][gone],
                bytes=np.zeros(n, np.uint8),
            )
            yield removed
        stay = np.flatnonzero(~gone)
        bucket = _bucket(found["hash"][stay], buckets)
        order = np.argsort(bucket, kind="stable")
        stay, bucket = stay[order], bucket[order]
        cuts, rows = _cuts(bucket), []
        for a, b in zip(cuts, cuts[1:]):
            own = stay[a:b]
            low = found["hash"][own] & _LOW
            strings, _ = _strings(data, begin[own], found["length"][own])
            rows.append(
                (
                    int(bucket[a]),
                    low.astype(np.uint32).tobytes(),
                    (low >> np.uint64(32)).astype(np.uint8).tobytes(),
                    found["offset"][own].astype(np.uint8).tobytes(),
                    found["length"][own].astype(np.uint8).tobytes(),
                    *(found[c][own].tobytes() for c in ("doc", "version", "start")),
                    strings.tobytes(),
                )
            )
        if rows:
            columns = list(zip(*rows))
            names = ["key", "low", "high", "offset", "length", "doc", "version", "start", "bytes"]
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), *[pa.array(c, pa.binary()) for c in columns[1:]]], names)

    def run(batches):
        held, size = [], 0
        for batch in batches:
            data, starts = utf8(batch.column("text"))
            doc, version = (batch.column(c).to_numpy() for c in ("doc", "version"))
            places = [np.frombuffer(x, np.int64) for x in batch.column("places").to_pylist()]
            for a, b in pieces(starts):
                part, begin = data[starts[a] : starts[b]], starts[a : b + 1] - starts[a]
                found = anchors(part, begin)
                wanted = np.concatenate([p + s for p, s in zip(places[a:b], begin)])
                # Both rise; a place is the anchor of one run of windows, or of none.
                slot = np.minimum(np.searchsorted(wanted, found["at"]), max(len(wanted) - 1, 0))
                hit = wanted[slot] == found["at"] if len(wanted) else np.zeros(len(slot), bool)
                row, first, last, at, hashed = (found[c][hit] for c in ("row", "first", "last", "at", "hash"))
                offset, length = at - first, last - first + LENGTH
                if len(often) and (apart := np.isin(_name(_bucket(hashed, named_by), hashed), often)).any():
                    windows = np.where(apart, last - first + 1, 1)
                    which = np.repeat(np.arange(len(first)), windows)
                    step = np.arange(len(which)) - np.repeat(np.cumsum(windows) - windows, windows)
                    apart, first = apart[which], first[which] + step
                    length = np.where(apart, LENGTH, length[which])
                    offset = np.where(apart, 0, offset[which])
                    row, hashed = row[which], hashed[which]
                    alone, _ = _strings(part, first[apart], length[apart])
                    whole = Hashes(alone, length[apart])
                    hashed[apart] = stir(whole.of(np.arange(len(length[apart])) * LENGTH, LENGTH))
                strings, where = _strings(part, first, length)
                held.append(
                    {
                        "data": strings, "begin": where, "hash": hashed, "offset": offset, "length": length,
                        "doc": doc[a:b][row], "version": version[a:b][row], "start": first - begin[row],
                    }
                )
                size += len(strings)
                if size >= FLUSH_BYTES:
                    yield from flushed(held)
                    held, size = [], 0
        if size:
            yield from flushed(held)

    return run


RANGES = "key long, doc binary, version binary, at binary, count binary"


def _removed(shelves: int):
    """Runs of starts of windows that stand earlier, packed by the shelf of their document."""

    def out(doc, version, at, count):
        return _packed(_shelf(doc, version, shelves), doc=doc, version=version, at=at, count=count.astype(np.uint8))

    def run(batches):
        for key, rows in _groups(batches):
            found = _joined(rows, offset=np.uint8, length=np.uint8, doc=np.int64, version=np.int64, start=np.int64)
            offset, length = found["offset"].astype(np.int64), found["length"].astype(np.int64)
            doc, version, start = found["doc"], found["version"], found["start"]
            windows = length - LENGTH + 1
            if key < 0:
                yield out(doc, version, start, windows)
                continue
            more = _joined(rows, low=np.uint32, high=np.uint8, bytes=np.uint8)
            rows.clear()
            anchor = more["low"].astype(np.uint64) | more["high"].astype(np.uint64) << np.uint64(32)
            begin = np.cumsum(length) - length
            for own in _whole(anchor, length, COMPARED_BYTES):
                strings, at = _strings(more["bytes"], begin[own], length[own])
                hashes = Hashes(strings, length[own])
                part = (anchor[own], offset[own], length[own], doc[own], start[own], at)
                gone, which, step = _earlier_exists(hashes, *part)
                if gone.any():
                    yield out(doc[own][gone], version[own][gone], start[own][gone], windows[own][gone])
                if len(which):
                    yield out(doc[own][which], version[own][which], start[own][which] + step, np.ones(len(which)))

    return run


def _whole(key: np.ndarray, size: np.ndarray, most: int):
    """Rows in the order of their key, all rows of a key together, of about ``most`` in size or one key."""
    order = np.argsort(key, kind="stable")
    cuts = np.array(_cuts(key[order]))
    upto = np.append(0, np.cumsum(size[order]))[cuts]
    a = 0
    while a < len(cuts) - 1:
        b = max(a + 1, int(np.searchsorted(upto, upto[a] + most, side="right")) - 1)
        yield order[cuts[a] : cuts[b]]
        a = b


def _earlier_exists(hashes, anchor, offset, length, doc, start, at):
    """Which segments equal an earlier one as a whole; and of the others the windows (segment, step) that do."""
    _, number = np.unique(anchor, return_inverse=True)
    gone = later_equals(hashes, (number << 20) | offset << 10 | length, at, length, doc, start)
    # Of segments that are equal in part: all windows that share a hash with another of their anchor and offset.
    stay = np.flatnonzero(~gone)
    stay = stay[np.bincount(number[stay], minlength=len(number))[number[stay]] > 1]
    windows = length - LENGTH + 1
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for own in _whole(number[stay], windows[stay], COMPARED_WINDOWS):
        own = stay[own]
        which = np.repeat(own, windows[own])
        step = np.arange(len(which)) - np.repeat(np.cumsum(windows[own]) - windows[own], windows[own])
        group = number[which] << 10 | (offset[which] - step + 512)
        whole = stir(hashes.of(at[which] + step, LENGTH) ^ stir(group.astype(np.uint64)))
        _, inverse, count = np.unique(whole, return_inverse=True, return_counts=True)
        pick = np.flatnonzero(count[inverse] > 1)
        which, step, group = which[pick], step[pick], group[pick]
        again = later_equals(hashes, group, at[which] + step, np.full(len(pick), LENGTH), doc[which], start[which] + step)
        found.append((which[again], step[again]))
    which, step = (np.concatenate(x) for x in zip(*found))
    return gone, which, step


def _ranges_per_document(batches):
    """From shelves, one row per document with the runs of starts, joined where they touch."""
    for _, rows in _groups(batches):
        found = _joined(rows, doc=np.int64, version=np.int64, at=np.int64, count=np.uint8)
        order = np.lexsort((found["at"], found["version"], found["doc"]))
        doc, version, at = (found[c][order] for c in ("doc", "version", "at"))
        end = at + found["count"][order].astype(np.int64)
        split = np.ones(len(at), bool)
        split[1:] = (doc[1:] != doc[:-1]) | (version[1:] != version[:-1]) | (at[1:] > end[:-1])
        head = np.flatnonzero(split)
        doc, version, at, end = doc[head], version[head], at[head], np.maximum.reduceat(end, head) if len(head) else end
        cuts = sorted({*_cuts(doc), *_cuts(version)})
        for a in range(0, len(cuts) - 1, 2000):
            part = cuts[a : a + 2001]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(doc[part[:-1]]),
                    pa.array(version[part[:-1]]),
                    pa.array([np.stack([at[x:y], end[x:y]]).tobytes() for x, y in zip(part, part[1:])], pa.binary()),
                ],
                ["doc", "version", "ranges"],
            )


def kept_bytes(text: bytes, ranges: bytes | None) -> tuple[bytes, int, int]:
    """What is left, and how many bytes went in how many runs. ``ranges``: window starts, first and past-the-last."""
    if not ranges:
        return text, 0, 0
    first, end = np.frombuffer(ranges, np.int64).reshape(2, -1)
    edge = np.zeros(len(text) + 1, np.int32)
    np.add.at(edge, first, 1)
    np.add.at(edge, end - 1 + LENGTH, -1)
    gone = np.cumsum(edge[:-1]) > 0
    runs = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
    return np.frombuffer(text, np.uint8)[~gone].tobytes(), int(gone.sum()), runs


def _rows(docs: DataFrame) -> DataFrame:
    """Document, version and text: rows of one id are told apart by what they say. A null id is the smallest."""
    text = F.col("text")
    return plain(docs, "doc_id", "text").select(
        "doc_id", F.coalesce("doc_id", F.lit(-(2**63))).alias("doc"), F.xxhash64(text).alias("version"), "text"
    )


def _bit() -> Column:
    return F.pmod(F.xxhash64("doc", "version"), F.lit(1 << FILTER_BITS))


def _filter(found: DataFrame) -> DataFrame:
    """A bitmap of the documents found, 32,768 bits a row; no more rows than FILTER_BITS allows."""
    bit = _bit()
    return found.groupBy(F.bitmap_bucket_number(bit).alias("_bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("_bits"))


def _maybe(rows: DataFrame, bits: DataFrame, there: bool) -> DataFrame:
    """Rows that the bitmap has (among them some that were not found), or has not."""
    place = F.bitmap_bit_position(_bit())
    byte = F.conv(F.hex(F.substring("_bits", (place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("long")
    held = F.coalesce(F.getbit(byte, (place % 8).cast("int")) == 1, F.lit(False))
    marked = rows.withColumn("_bucket", F.bitmap_bucket_number(_bit())).join(F.broadcast(bits), "_bucket", "left")
    return marked.where(held if there else ~held).drop("_bucket", "_bits")


def _with(rows: DataFrame, found: DataFrame, how: str) -> DataFrame:
    return rows.join(found, ["doc", "version"], how)


def removed_ranges(docs: DataFrame, split_from: int = SPLIT_FROM) -> DataFrame:
    """Per document with anything to remove: (doc, version, ranges), see :func:`kept_bytes`.

    Anchors that ``split_from`` flushes of tasks have are spread over buckets.
    """
    rows = _rows(docs)
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    tasks = partitions(docs, size // 40, PER_TASK)
    buckets = tasks * BUCKETS
    places = stored(
        _dealt(rows.select("doc", "version", "text").mapInArrow(_sent(buckets), SENT), tasks)
        .transform(lambda df: _dealt(df.mapInArrow(_repeated(buckets, split_from), PLACES), tasks))
        .mapInArrow(_per_document, "doc long, version long, places binary"),
        "places",
    )
    often = places.where("places IS NULL").orderBy(F.desc("version"), "doc").limit(SPLIT_MOST).select("doc").collect()
    often, named_by = np.array([r.doc for r in often], np.int64), buckets
    places = places.where("places IS NOT NULL")
    repeated = places.agg(F.sum(F.octet_length("places"))).first()[0] or 0
    tasks = partitions(docs, repeated // 8 * 140, TASK_BYTES)
    buckets = tasks * BUCKETS
    candidates = _with(_maybe(rows.select("doc", "version", "text"), _filter(places), True), places, "inner")
    segments = candidates.select("doc", "version", "text", "places").mapInArrow(_segments(buckets, often, named_by), SEGMENTS)
    return stored(
        _dealt(_dealt(segments, tasks).mapInArrow(_removed(buckets), RANGES), tasks)
        .mapInArrow(_ranges_per_document, "doc long, version long, ranges binary"),
        "ranges",
    )


def _dealt(packed: DataFrame, tasks: int) -> DataFrame:
    return packed.repartition(tasks, "key").sortWithinPartitions("key")


def _applied(batches):
    for batch in batches:
        out = []
        for doc_id, text, ranges in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "ranges"))):
            raw = text.encode("utf-8", "surrogatepass")
            kept, n, runs = kept_bytes(raw, ranges)
            out.append((doc_id, len(raw), n, runs, hashlib.sha256(kept).hexdigest()))
        columns = list(zip(*out)) or [[]] * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, [pa.int64()] * 4 + [pa.string()])],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        )


def remove_repeats(docs: DataFrame, split_from: int = SPLIT_FROM) -> DataFrame:
    """Per row: (doc_id, n_bytes, n_removed, n_spans, kept_sha256).

    Removes every byte that a string of 100 bytes covers which also starts earlier: in a
    smaller doc_id, or earlier in the same one. Strings are judged on the input and never
    cross rows; null text counts as empty and a null doc_id as the smallest. Rows that share
    an id are the same document, so copies under one id don't remove each other. Shorter
    texts lose nothing, and no rows give no rows. Only ``doc_id`` and ``text`` are read.
    """
    rows, ranges = _rows(docs), removed_ranges(docs, split_from)
    bits = _filter(ranges)
    untouched = _maybe(rows, bits, False).select(
        "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"),
        F.lit(0).cast("long").alias("n_spans"), F.sha2("text", 256).alias("kept_sha256"),
    )
    touched = _with(_maybe(rows, bits, True), ranges, "left").select("doc_id", "text", "ranges")
    return untouched.unionByName(touched.mapInArrow(_applied, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"))
