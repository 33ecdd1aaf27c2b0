"""Suffix-array deduplication of exact passages of ``LENGTH`` bytes.

Two suffixes repeat a passage if they agree in their first ``LENGTH`` bytes, so
the suffixes are sorted to that depth and equal neighbours share a passage.
Suffixes are compared by prefix polynomial hashes: a binary search finds how far
two of them agree, the next byte decides. A mergesort on such comparisons orders
them; the order found is then verified byte by byte, and a stretch that a hash
collision has put wrong is sorted by its bytes.

Not all suffixes of a corpus need to meet. The least ``GRAM``-byte hash inside a
passage is the same wherever the passage stands, so:

1. Texts are dealt into slices of whole documents. Each slice reports its least
   grams (about one in fourteen bytes, 8 bytes each) and learns which of them
   another document has too.
2. Around those, neighbouring suffixes with the same least gram form a stretch.
   A slice sends each distinct stretch once, with its smallest doc_id, to where
   all stretches of that gram meet; a gram in more than ``HOT`` documents is split
   by the passages' hashes. There equal stretches are merged, and where
   stretches differ, their suffixes are sorted.
3. Each slice gets back, as bits, which of its suffixes stand in a document with
   a smaller doc_id, and removes what they cover.

No group grows with the number of copies: a slice sends a stretch once however
often it holds it. Slices are kept compressed in a table bucketed by slice, so
that answers come to the texts and not the texts to the answers.

Null texts are empty; texts under ``LENGTH`` bytes lose nothing. Null ids count as
larger than any id and not as different from each other; rows that repeat an id
are one document in that they do not remove each other's bytes. Extra columns
are not read, empty tables give no rows. A document longer than a slice is a
slice of its own, worked on in blocks; one task then holds that text and about
as much again in positions.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercadal.llm.tables import packed, runs_of, stored, text_or_empty, unpacked, utf8_values
from mercadal.session import local_table, scratch_path

LENGTH = 50
GRAM = 24
STRETCH = 32  # suffixes of a stretch, as bits of a mask
SLICE = 4 << 20
BLOCK = 1 << 20
PART = 1 << 20  # bytes of stretches that are sorted at once
BUCKET_TEXT = 16 << 20  # bytes of text behind one group of grams
SLICES_A_TASK = 4
HOT = 4096
NO_ID = np.iinfo(np.int64).max
OUTPUT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
_BASE = 0x9E3779B97F4A7C15
_VALUES = np.random.default_rng(13).integers(0, 1 << 64, 256, dtype=np.uint64) | np.uint64(1)
_powers: dict[int, np.ndarray] = {}


# ----------------------------------------------------------------------- hashes
def powers(base: int, size: int) -> np.ndarray:
    if base not in _powers or len(_powers[base]) < size:
        table = np.full(max(size, BLOCK + 2 * LENGTH), base, dtype=np.uint64)
        table[0] = 1
        _powers[base] = np.cumprod(table, dtype=np.uint64)
    return _powers[base][:size]


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


class Prefixes:
    """Prefix polynomial hashes of a byte sequence."""

    def __init__(self, data: np.ndarray):
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(_VALUES[data] * powers(_BASE, len(data)), out=self.sums[1:])
        self.back = powers(pow(_BASE, -1, 1 << 64), len(data) + 1)

    def of(self, at: np.ndarray, length) -> np.ndarray:
        """Hashes of ``length`` bytes from each place."""
        return (self.sums[at + length] - self.sums[at]) * self.back[at]

    def every(self, length: int) -> np.ndarray:
        count = max(len(self.sums) - length, 0)
        return (self.sums[length:] - self.sums[:count]) * self.back[:count]


# ------------------------------------------------------------------ suffix sort
def common(prefixes: Prefixes, a: np.ndarray, b: np.ndarray, depth: int) -> np.ndarray:
    """Length of the common extension of suffixes at ``a`` and ``b``, up to ``depth``."""
    low, high = np.zeros(len(a), dtype=np.int64), np.full(len(a), depth)
    for _ in range(depth.bit_length()):
        middle = (low + high + 1) >> 1
        same = prefixes.of(a, middle) == prefixes.of(b, middle)
        low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        high = np.maximum(high, low)
    return low


def comes_first(data: np.ndarray, prefixes: Prefixes, a: np.ndarray, b: np.ndarray, depth: int, ties: np.ndarray) -> np.ndarray:
    """Is the suffix at ``a`` before that at ``b``? ``ties`` is the answer for equal ones."""
    n = common(prefixes, a, b, depth)
    whole = n == depth
    n = np.where(whole, 0, n)
    return np.where(whole, ties, data[a + n] < data[b + n])


def merge_sort(data: np.ndarray, prefixes: Prefixes, starts: np.ndarray, first: np.ndarray, last: np.ndarray, depth: int) -> np.ndarray:
    """Sorts suffix starts inside segments; ``first`` and ``last`` give each
    place the bounds of its segment. All runs of one width are merged at once: an
    element moves by the number of elements of the other run that precede it."""
    starts = starts.copy()
    place = np.arange(len(starts))
    width, longest = 1, int((last - first).max(initial=0))
    while width < longest:
        at = place[last - first > width]
        begin, end = first[at], last[at]
        inner = at - begin
        block = begin + inner // (2 * width) * (2 * width)
        is_left = at - block < width
        low = np.where(is_left, np.minimum(block + width, end), block)
        high = np.where(is_left, np.minimum(block + 2 * width, end), block + width)
        own = np.where(is_left, at - block, at - block - width)
        other = low.copy()
        mine = starts[at]
        while (going := np.flatnonzero(low < high)).size:
            middle = (low[going] + high[going]) >> 1
            # of equal suffixes those of the left run stay first
            ahead = comes_first(data, prefixes, starts[middle], mine[going], depth, ~is_left[going])
            low[going] = np.where(ahead, middle + 1, low[going])
            high[going] = np.where(ahead, high[going], middle)
        moved = starts.copy()
        moved[block + own + (low - other)] = mine
        starts = moved
        width *= 2
    return starts


def segment_bounds(new: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    begins = np.flatnonzero(new)
    sizes = np.diff(np.append(begins, len(new)))
    return np.repeat(begins, sizes), np.repeat(begins + sizes, sizes)


def sorted_suffixes(data: np.ndarray, starts: np.ndarray, groups: np.ndarray, depth: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes at ``starts`` by group and first ``depth`` bytes, and
    whether each of them equals the one before it."""
    prefixes = Prefixes(data)
    words = sum(data[starts + i].astype(np.uint64) << np.uint64(56 - 8 * i) for i in range(min(8, depth)))
    order = np.lexsort((words, groups))
    g, w = groups[order], words[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (g[1:] != g[:-1]) | (w[1:] != w[:-1])
    first, last = segment_bounds(new)
    # suffixes are told apart by their place in ``order``
    where = np.argsort(starts[order], kind="stable")
    by_start = starts[order][where]
    placed = merge_sort(data, prefixes, starts[order], first, last, depth)
    equal = np.zeros(len(order), dtype=bool)
    wrong: list[int] = []
    span = np.arange(depth)
    for begin in range(1, len(placed), 1 << 16):
        at = np.arange(begin, min(begin + (1 << 16), len(placed)))
        at = at[~new[at]]
        left, right = data[placed[at - 1][:, None] + span], data[placed[at][:, None] + span]
        differs = left != right
        apart = differs.any(axis=1)
        spot = differs.argmax(axis=1)
        row = np.arange(len(at))
        wrong += first[at[apart & (left[row, spot] > right[row, spot])]].tolist()
        equal[at] = ~apart
    for begin in sorted(set(wrong)):  # a collision of hashes
        end = int(last[begin])
        part = sorted(placed[begin:end].tolist(), key=lambda s: data[s : s + depth].tobytes())
        placed[begin:end] = part
        for i in range(begin + 1, end):
            equal[i] = (data[part[i - begin] + span] == data[part[i - begin - 1] + span]).all()
    # suffixes of different groups may begin at one place: they keep their number
    back = np.argsort(placed, kind="stable")
    numbers = np.empty(len(order), dtype=np.int64)
    assert (placed[back] == by_start).all()
    numbers[back] = order[where]
    return numbers, equal


# ----------------------------------------------------------------------- slices
def rows_of(columns: dict[str, list], schema: dict[str, pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[k], t) for k, t in schema.items()], names=list(schema))


SLICES = {"slice": pa.int64(), "blob": pa.binary()}
REPORTS = {"bucket": pa.int64(), "slice": pa.int64(), "data": pa.binary()}
ANSWERS = {"slice": pa.int64(), "bucket": pa.int64(), "data": pa.binary()}


def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices of a task's documents: ids, lengths and bytes."""
    number = TaskContext.get().partitionId() << 33
    ids: list[int] = []
    texts: list[bytes] = []
    size = 0

    def whole():
        lengths = np.array([len(t) for t in texts], dtype=np.int64)
        data = np.frombuffer(b"".join(texts), dtype=np.uint8)
        return rows_of({"slice": [number], "blob": [packed(np.array(ids, dtype=np.int64), lengths, data)]}, SLICES)

    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), utf8_values(batch.column(1)), strict=True):
            if texts and size + len(text) > SLICE:
                yield whole()
                number, ids, texts, size = number + 1, [], [], 0
            ids.append(NO_ID if doc_id is None else doc_id)
            texts.append(text)
            size += len(text)
    if texts:
        yield whole()


class Stretches:
    """The stretches of a slice: runs of suffixes with the same least gram."""

    def __init__(self, blob: bytes):
        self.ids, self.lengths, self.data = unpacked(blob)
        self.bounds = np.append(0, np.cumsum(self.lengths))
        parts = [self._of_block(a) for a in range(0, len(self.data), BLOCK)]
        self.start, self.count, self.gram = (
            np.concatenate(x) for x in zip(*(parts or [(np.zeros(0, int), np.zeros(0, int), np.zeros(0, np.uint64))]), strict=True)
        )
        self.doc = np.searchsorted(self.bounds, self.start, side="right") - 1

    def _of_block(self, begin: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        data = self.data[begin : begin + BLOCK + LENGTH - 1]
        count = len(data) - LENGTH + 1
        if count <= 0:
            return np.zeros(0, int), np.zeros(0, int), np.zeros(0, np.uint64)
        least, width, run = mix(Prefixes(data).every(GRAM)), 1, LENGTH - GRAM + 1
        while width * 2 <= run:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        least = np.minimum(least[: len(least) - (run - width)], least[run - width :])
        fits = np.ones(count, dtype=bool)
        # no passage begins in the last LENGTH - 1 bytes of a document
        first, last = np.searchsorted(self.bounds, [begin + 1, begin + len(data)])
        for end in self.bounds[max(first, 1) : last + 1]:
            fits[max(end - begin - LENGTH + 1, 0) : max(end - begin, 0)] = False
        new = fits.copy()
        new[1:] &= (least[1:] != least[:-1]) | ~fits[:-1]
        starts = np.flatnonzero(new)
        stops = np.ones(count, dtype=bool)
        stops[:-1] = new[1:] | ~fits[1:]
        ends = np.flatnonzero(stops & fits) + 1
        pieces = -(-(ends - starts) // STRETCH)
        if (pieces > 1).any():
            nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            starts = np.repeat(starts, pieces) + nth * STRETCH
            ends = np.minimum(starts + STRETCH, np.repeat(ends, pieces))
        return starts + begin, ends - starts, least[starts]

    def grams(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct grams, ascending, and the number of rows with each (255 at most)."""
        order = np.argsort(self.gram, kind="stable")
        gram, doc = self.gram[order], self.doc[order]
        new = np.ones(len(gram), dtype=bool)
        new[1:] = gram[1:] != gram[:-1]
        other = new.copy()
        other[1:] |= doc[1:] != doc[:-1]
        begins = np.flatnonzero(new)
        number = np.add.reduceat(other, begins, dtype=np.int64) if len(begins) else np.zeros(0, np.int64)
        return gram[begins], np.minimum(number, 255).astype(np.uint8)


class Sent:
    """What a slice sends: its distinct stretches with a shared gram. ``shared``
    and ``pieces`` are the ascending grams it was told and in how many each is
    split. Made anew from the same slice and answers it is the same."""

    def __init__(self, slice_: Stretches, shared: np.ndarray, pieces: np.ndarray, buckets: int):
        spot = np.minimum(np.searchsorted(shared, slice_.gram), max(len(shared) - 1, 0))
        known = shared[spot] == slice_.gram if len(shared) else np.zeros(len(slice_.gram), dtype=bool)
        self.at = np.flatnonzero(known)
        start, count = slice_.start[self.at], slice_.count[self.at]
        size = count + LENGTH - 1
        width = LENGTH + STRETCH
        ids = slice_.ids[slice_.doc[self.at]]
        text = np.zeros((len(start), width), dtype=np.uint8)
        span = np.arange(width - 1)
        for a in range(0, len(start), 1 << 14):
            b = slice(a, a + (1 << 14))
            inside = span < size[b][:, None]
            text[b, :-1] = np.where(inside, slice_.data[np.minimum(start[b][:, None] + span, len(slice_.data) - 1)], 0)
        text[:, -1] = size
        _, first, self.which = np.unique(text.view(f"S{width}").reshape(-1), return_index=True, return_inverse=True)
        self.text, self.size = text[first], size[first]
        self.least = np.full(len(first), NO_ID)
        np.minimum.at(self.least, self.which, ids)
        self.gram = slice_.gram[self.at[first]]
        split = pieces[spot[self.at[first]]].astype(np.int64) if len(first) else np.zeros(0, np.int64)
        # (stretch, piece, mask) of what is sent, ordered by bucket
        stretch, piece = np.arange(len(first)), np.zeros(len(first), dtype=np.int64)
        mask = np.full(len(first), (1 << STRETCH) - 1, dtype=np.uint64)
        if (split > 1).any():
            hot = np.flatnonzero(split > 1)
            parts = [self._dealt(i, int(split[i])) for i in hot]
            plain = split == 1
            stretch, piece, mask = (
                np.concatenate([x[plain], *y]) for x, y in zip((stretch, piece, mask), zip(*parts, strict=True), strict=True)
            )
        bucket = (mix(self.gram[stretch] + piece.astype(np.uint64) * np.uint64(_BASE)) % np.uint64(buckets)).astype(np.int64)
        order = np.lexsort((piece, stretch, bucket))
        self.stretch, self.mask, self.bucket = stretch[order], mask[order], bucket[order]

    def _dealt(self, i: int, pieces: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pieces that the suffixes of stretch ``i`` belong to, by their passages."""
        count = int(self.size[i]) - LENGTH + 1
        own = (mix(Prefixes(self.text[i, : self.size[i]]).every(LENGTH)) % np.uint64(pieces)).astype(np.int64)
        found = np.unique(own)
        bits = [np.bitwise_or.reduce(np.uint64(1) << np.flatnonzero(own[:count] == p).astype(np.uint64)) for p in found]
        return np.full(len(found), i), found, np.array(bits, dtype=np.uint64)

    def by_bucket(self) -> Iterator[tuple[int, np.ndarray]]:
        """(bucket, places in ``stretch`` and ``mask``)."""
        for begin, end in runs_of(self.bucket):
            yield int(self.bucket[begin]), np.arange(begin, end)


# ----------------------------------------------------------------- work of tasks
def report_grams(buckets: int):
    def run(batches):
        for batch in batches:
            for number, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                grams, rows = Stretches(blob).grams()
                home = (mix(grams.copy()) % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(home, kind="stable")
                out = {"bucket": [], "slice": [], "data": []}
                for a, b in runs_of(home[order]):
                    out["bucket"].append(int(home[order[a]]))
                    out["slice"].append(number)
                    out["data"].append(grams[order[a:b]].tobytes() + rows[order[a:b]].tobytes())
                yield rows_of(out, REPORTS)

    return run


def shared_grams(group: pa.Table) -> pa.Table:
    """For each slice those of its grams that stand in more than one document."""
    slices_ = group["slice"].to_pylist()
    reports = []
    for raw in group["data"].to_pylist():  # nine bytes a gram: its hash, then its rows
        n = len(raw) // 9
        reports.append((np.frombuffer(raw, dtype=np.uint64, count=n), np.frombuffer(raw, dtype=np.uint8, offset=8 * n)))
    grams = np.concatenate([r[0] for r in reports])
    rows = np.concatenate([r[1] for r in reports]).astype(np.int64)
    order = np.argsort(grams, kind="stable")
    begins = np.flatnonzero(np.append(True, np.diff(grams[order]) != 0))
    total = np.add.reduceat(rows[order], begins)
    number = np.empty(len(grams), dtype=np.int64)
    number[order] = np.repeat(total, np.diff(np.append(begins, len(grams))))
    pieces = np.minimum(-(-number // HOT), np.iinfo(np.uint16).max).astype(np.uint16)
    out = {"slice": [], "bucket": [], "data": []}
    ends = np.cumsum([len(r[0]) for r in reports])
    for s, bucket, a, b in zip(slices_, group["bucket"].to_pylist(), [0, *ends[:-1]], ends, strict=True):
        if (some := np.flatnonzero(number[a:b] > 1)).size:
            out["slice"].append(s)
            out["bucket"].append(bucket)
            out["data"].append(packed(grams[a:b][some], pieces[a:b][some]))
    return pa.Table.from_batches([rows_of(out, ANSWERS)])


def told(answers: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    parts = [unpacked(raw) for raw in answers["data"].to_pylist()]
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint16)
    grams, pieces = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(grams)
    return grams[order], pieces[order]


def send_stretches(buckets: int):
    def run(slices_: pa.Table, answers: pa.Table) -> pa.Table:
        out = {"bucket": [], "slice": [], "data": []}
        for number, blob in zip(slices_["slice"].to_pylist(), slices_["blob"].to_pylist(), strict=True):
            sent = Sent(Stretches(blob), *told(answers), buckets)
            for bucket, at in sent.by_bucket():
                s = sent.stretch[at]
                inside = np.arange(LENGTH + STRETCH) < sent.size[s][:, None]
                out["bucket"].append(bucket)
                out["slice"].append(number)
                out["data"].append(
                    packed(sent.gram[s], sent.least[s], sent.size[s].astype(np.uint8), sent.mask[at].astype(np.uint32), sent.text[s][inside])
                )
        return pa.Table.from_batches([rows_of(out, REPORTS)])

    return run


def distinct_stretches(data: np.ndarray, start: np.ndarray, size: np.ndarray, gram: np.ndarray) -> np.ndarray:
    """Class number of each stretch; equal bytes, equal class. Hashes propose,
    bytes decide."""
    key = mix(Prefixes(data).of(start, size)) + size.astype(np.uint64)
    order = np.lexsort((key, gram))
    k, g = key[order], gram[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (k[1:] != k[:-1]) | (g[1:] != g[:-1])
    first, last = segment_bounds(new)
    span = np.arange(LENGTH + STRETCH - 1)
    wrong = set()
    for begin in range(0, len(order), 1 << 15):
        at = np.arange(begin, min(begin + (1 << 15), len(order)))
        at = at[~new[at]]
        a, b = order[first[at]], order[at]
        n = np.minimum(size[a], size[b])[:, None]
        inside = span < n
        left = data[np.minimum(start[a][:, None] + span, len(data) - 1)]
        right = data[np.minimum(start[b][:, None] + span, len(data) - 1)]
        wrong |= set(first[at[((left != right) & inside).any(axis=1) | (size[a] != size[b])]].tolist())
    for begin in sorted(wrong):  # a collision of hashes
        end = int(last[begin])
        text = {int(i): data[start[i] : start[i] + size[i]].tobytes() for i in order[begin:end]}
        part = sorted(text, key=text.get)
        order[begin:end] = part
        new[begin + 1 : end] = [text[a] != text[b] for a, b in zip(part, part[1:], strict=False)]
    out = np.empty(len(order), dtype=np.int64)
    out[order] = np.cumsum(new) - 1
    return out


def earlier_suffixes(gram, least, size, mask, data) -> np.ndarray:
    """For each stretch the bits of the suffixes whose passage some stretch of a
    smaller doc_id holds."""
    start = np.append(0, np.cumsum(size)[:-1])
    class_ = distinct_stretches(data, start, size, gram)
    number = int(class_.max()) + 1
    low = np.full(number, NO_ID)
    np.minimum.at(low, class_, least)
    sample = np.zeros(number, dtype=np.int64)
    sample[class_] = np.arange(len(class_))
    wanted = np.zeros(number, dtype=np.uint32)  # two pieces of a gram may meet here
    np.bitwise_or.at(wanted, class_, mask)
    # all suffixes of a class: equal to the class unless other classes share the gram
    of_gram = gram[sample]
    order = np.argsort(of_gram, kind="stable")
    same = np.zeros(number, dtype=bool)
    near = of_gram[order][1:] == of_gram[order][:-1]
    same[order[1:]] |= near
    same[order[:-1]] |= near
    best = np.repeat(low[:, None], STRETCH, axis=1)
    several = np.flatnonzero(same)
    if len(several):
        bits = (wanted[several][:, None] >> np.arange(STRETCH, dtype=np.uint32)) & np.uint32(1)
        bits &= (np.arange(STRETCH) < (size[sample[several]] - LENGTH + 1)[:, None]).astype(np.uint32)
        row, offset = np.nonzero(bits)
        # only the text of these classes is hashed and sorted
        sizes = size[sample[several]]
        place = np.append(0, np.cumsum(sizes)[:-1])
        spread = np.repeat(start[sample[several]] - place, sizes) + np.arange(sizes.sum())
        groups = np.unique(of_gram[several], return_inverse=True)[1][row]
        numbers, equal = sorted_suffixes(data[spread], place[row] + offset, groups)
        begins = np.flatnonzero(~equal)
        least_of_run = np.minimum.reduceat(low[several[row[numbers]]], begins)
        found = np.empty(len(row), dtype=np.int64)
        found[numbers] = np.repeat(least_of_run, np.diff(np.append(begins, len(numbers))))
        best[several[row], offset] = found
    out = np.zeros(len(class_), dtype=np.uint32)
    for a in range(0, len(out), 1 << 16):
        b = slice(a, a + (1 << 16))
        hit = best[class_[b]] < least[b][:, None]
        hit &= np.arange(STRETCH) < (size[b] - LENGTH + 1)[:, None]
        out[b] = (hit.astype(np.uint32) << np.arange(STRETCH, dtype=np.uint32)).sum(axis=1, dtype=np.uint32)
    return out & mask


def answer_stretches(group: pa.Table) -> pa.Table:
    reports = [unpacked(raw) for raw in group["data"].to_pylist()]
    gram, least, size, mask, data = (np.concatenate(x) for x in zip(*reports, strict=True))
    size = size.astype(np.int64)
    start = np.append(0, np.cumsum(size)[:-1])
    earlier = np.zeros(len(gram), dtype=np.uint32)
    # grams do not meet each other: some of them at a time
    share = (mix(gram ^ np.uint64(_BASE)) % np.uint64(len(data) // PART + 1)).astype(np.int64)
    order = np.argsort(share, kind="stable")
    for a, b in runs_of(share[order]):
        some = order[a:b]
        sizes = size[some]
        place = np.append(0, np.cumsum(sizes)[:-1])
        text = data[np.repeat(start[some] - place, sizes) + np.arange(sizes.sum())]
        earlier[some] = earlier_suffixes(gram[some], least[some], sizes, mask[some], text)
    out = {"slice": [], "bucket": [], "data": []}
    ends = np.cumsum([len(r[0]) for r in reports])
    for s, bucket, a, b in zip(group["slice"].to_pylist(), group["bucket"].to_pylist(), [0, *ends[:-1]], ends, strict=True):
        if earlier[a:b].any():
            out["slice"].append(s)
            out["bucket"].append(-1 - bucket)  # told from the answers about grams
            out["data"].append(packed(earlier[a:b]))
    return pa.Table.from_batches([rows_of(out, ANSWERS)])


def removed_starts(slice_: Stretches, sent: Sent, masks: dict[int, np.ndarray]) -> np.ndarray:
    """Starts of the passages of a slice that a smaller doc_id holds too."""
    bits = np.zeros(len(sent.least), dtype=np.uint32)
    for bucket, at in sent.by_bucket():
        if bucket in masks:
            np.bitwise_or.at(bits, sent.stretch[at], masks[bucket])
    own = slice_.ids[slice_.doc[sent.at]] == sent.least[sent.which]
    mine = np.where(own, bits[sent.which], np.uint32((1 << STRETCH) - 1))
    count = slice_.count[sent.at]
    out = []
    for a in range(0, len(mine), 1 << 16):
        b = slice(a, a + (1 << 16))
        hit = ((mine[b][:, None] >> np.arange(STRETCH, dtype=np.uint32)) & np.uint32(1)).astype(bool)
        hit &= np.arange(STRETCH) < count[b][:, None]
        row, offset = np.nonzero(hit)
        out.append(slice_.start[sent.at[b]][row] + offset)
    return np.concatenate(out) if out else np.zeros(0, dtype=np.int64)


def removal(buckets: int):
    def run(slices_: pa.Table, answers: pa.Table) -> pa.Table:
        about_grams = answers.filter(pa.compute.greater_equal(answers["bucket"], 0))
        masks = {-1 - k: unpacked(raw)[0] for k, raw in zip(answers["bucket"].to_pylist(), answers["data"].to_pylist(), strict=True) if k < 0}
        out = {name: [] for name in ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")}
        for blob in slices_["blob"].to_pylist():
            slice_ = Stretches(blob)
            starts = removed_starts(slice_, Sent(slice_, *told(about_grams), buckets), masks)
            edge = np.zeros(len(slice_.data) + 1, dtype=np.int32)
            edge[starts] += 1
            edge[starts + LENGTH] -= 1
            gone = np.cumsum(edge[:-1]) > 0
            begins = gone.copy()
            begins[1:] &= ~gone[:-1]
            inner = slice_.bounds[slice_.bounds < len(gone)]
            begins[inner] |= gone[inner]
            removed, spans = (np.diff(np.append(0, np.cumsum(x))[slice_.bounds]) for x in (gone, begins))
            for i, (a, b) in enumerate(zip(slice_.bounds, slice_.bounds[1:], strict=False)):
                kept = slice_.data[a:b][~gone[a:b]] if removed[i] else slice_.data[a:b]
                out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
            out["doc_id"] += [None if i == NO_ID else i for i in slice_.ids.tolist()]
            out["n_bytes"] += slice_.lengths.tolist()
            out["n_removed"] += removed.tolist()
            out["n_spans"] += spans.tolist()
        kinds = [pa.int64()] * 4 + [pa.string()]
        return pa.table({k: pa.array(v, t) for (k, v), t in zip(out.items(), kinds, strict=True)})

    return run


# -------------------------------------------------------------------- operators
def sliced(docs: DataFrame, total: int) -> DataFrame:
    """The slices as files bucketed by slice, so that they are never shuffled.
    The table's name is given up at once; its files stay in the scratch folder."""
    spark = docs.sparkSession
    name, path = f"slices_{uuid.uuid4().hex}", scratch_path(spark, "slices")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    made = rows.mapInArrow(cut, "slice long, blob binary")
    tasks = max(1, -(-total // (SLICES_A_TASK * SLICE)))
    made.write.bucketBy(tasks, "slice").option("path", path).option("compression", "none").saveAsTable(name)
    slices_ = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return slices_


def repeats_removed(docs: DataFrame) -> DataFrame:
    """What is left of each document (see the module)."""
    total = docs.agg(F.sum(F.octet_length(text_or_empty()).cast("long"))).first()[0]
    if total is None:
        return local_table(docs.sparkSession, [], OUTPUT)
    slices_, buckets = sliced(docs, total), max(1, -(-total // BUCKET_TEXT))
    reports = slices_.mapInArrow(report_grams(buckets), "bucket long, slice long, data binary")
    grams = stored(reports.groupBy("bucket").applyInArrow(shared_grams, "slice long, bucket long, data binary"), "grams")
    by_slice = slices_.groupBy("slice")
    sent = by_slice.cogroup(grams.groupBy("slice")).applyInArrow(send_stretches(buckets), "bucket long, slice long, data binary")
    answers = sent.groupBy("bucket").applyInArrow(answer_stretches, "slice long, bucket long, data binary")
    return by_slice.cogroup(grams.unionByName(answers).groupBy("slice")).applyInArrow(removal(buckets), OUTPUT)
