"""Removal of repeated strings by sorting suffixes with a difference cover.

Every byte covered by a string of ``LENGTH`` bytes that also starts elsewhere goes.

**Dealing.**  Suffixes have to meet only where their first LENGTH bytes can be equal.
Each window of LENGTH bytes is dealt by the least hash among its grams of GRAM bytes:
equal windows have the same least gram at the same distance from their start, so they go
to the same group.  Grams that occur once anywhere are done with at once, and so are
occurrences whose whole context, SIDE bytes before the gram and SIDE after it, has an
equal: all windows of such a context repeat.

**Reduced text.**  What is left of a group are its distinct contexts.  They agree in the
gram, so it is written as one letter, and a context is up to SIDE letters, that letter, and
up to SIDE more.  The windows of a context are the strings of SIDE + 1 letters over it.

**Difference cover.**  The contexts of a task's groups are sorted suffix by suffix with the
cover {1, 2} modulo 3: triples at the sampled places are sorted and named; the string of
names is sorted by recursion, until names are distinct or span more letters than a window
has; the remaining suffixes are sorted by their first letter and the rank behind it, and
merged with the sampled ones.  Then neighbours' prefixes are compared.

A group with very many contexts is dealt again by narrower ranges of distance: windows that
start between x and y bytes before the gram have x bytes before and SIDE - y bytes after it
in common, so these bytes join the key, and the letters left are fewer by as many.

All intermediate tables are numbers: (hash, text key, place).  Texts move twice: all of them
once, joined with the places found in them, and the few that have such places again.

**Passages.**  Passages of over 50 words that other documents have too may be shorter than
LENGTH: they are counted, not removed.  Of RUNS neighbouring runs of RUN words the one with
the least hash is taken, so that whatever 51 words two documents share, they have a taken run
in common.  White space between words may differ.

Hashes of 64 bits tell texts, grams, contexts and runs apart; equal whole texts are told by
SHA-256, and the letters that are sorted are compared one by one.

Defined cases: null counts as empty.  Texts shorter than LENGTH lose nothing.  Equal texts
of at least LENGTH bytes, repeated rows among them, lose everything.  Matches never cross
documents; within one they may overlap.  Null and repeated ids are allowed: rows are told
by their text.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmill.llm.flat import _power, _SPREAD, mix, slices, words
from quillmill.staging import drop, stage

LENGTH, GRAM = 400, 300
SIDE = LENGTH - GRAM
RUN, RUNS = 40, 12  # words of a run, and how many runs in a row of which one is taken: together 51 words
LETTERS = 1 << 19  # letters that are sorted at a time
NARROW = 10  # the side of a range of a group that is dealt again
_TOP = np.uint64(0xFFFFFFFFFFFFFFFF)
_ODD = np.uint64(0x9E3779B97F4A7C15)


# -- difference cover ------------------------------------------------------------------------------


def suffix_ranks(t: np.ndarray, span: int) -> np.ndarray:
    """A number for each suffix of ``t`` that orders them by their first ``span`` letters at least; equal for equal ones.

    Letters are 0 and up, and below 2**21.
    """
    n = len(t)
    s = np.zeros(n + 3, np.uint64)
    s[:n] = t
    places = np.arange(n)
    one, two, zero = places[1::3], places[2::3], places[0::3]
    sample = np.concatenate([one, two])
    triple = (s[sample] << np.uint64(42)) | (s[sample + 1] << np.uint64(21)) | s[sample + 2]
    distinct, names = np.unique(triple, return_inverse=True)
    if len(distinct) < len(sample) and span > 3:
        inner = np.zeros(len(sample) + 2, np.int64)
        inner[: len(one)] = names[: len(one)] + 1
        inner[len(one) + 1 : -1] = names[len(one) :] + 1
        deep = suffix_ranks(inner, -(-span // 3))
        names = np.concatenate([deep[: len(one)], deep[len(one) + 1 : -1]])
        names = np.unique(names, return_inverse=True)[1]
    rank = np.zeros(n + 3, np.uint64)  # 0: behind the end
    rank[sample] = names.astype(np.uint64) + np.uint64(1)
    # the remaining suffixes, by a letter and a rank, or by two letters and a rank
    wide = np.uint64(22)
    by_one = lambda i: (s[i] << wide) | rank[i + 1]
    by_two = lambda i: (s[i] << np.uint64(43)) | (s[i + 1] << wide) | rank[i + 2]
    order = np.argsort(by_one(zero), kind="stable")
    zero = zero[order]
    keys = by_one(zero)
    lead = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(zero) else np.zeros(0, np.int64)
    own_zero = np.repeat(lead, np.diff(np.r_[lead, len(zero)]))
    sorted_one = one[np.argsort(rank[one], kind="stable")]
    sorted_two = two[np.argsort(rank[two], kind="stable")]
    out = np.zeros(n, np.int64)
    # of each suffix, how many are less
    counts = np.bincount(names, minlength=1) if len(names) else np.zeros(1, np.int64)
    below = np.concatenate([[0], np.cumsum(counts)[:-1]])
    out[sample] = below[names] if len(names) else 0
    out[sorted_one] += np.searchsorted(keys, by_one(sorted_one), "left")
    out[sorted_two] += np.searchsorted(by_two(zero), by_two(sorted_two), "left")
    out[zero] = own_zero + np.searchsorted(by_one(sorted_one), keys, "left") + np.searchsorted(by_two(sorted_two), by_two(zero), "left")
    return out


def repeated_windows(t: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    """Of each start whether the ``width`` letters from it are also those from another start."""
    rank = suffix_ranks(t, width)
    order = starts[np.argsort(rank[starts], kind="stable")]
    view = np.lib.stride_tricks.sliding_window_view(np.r_[t, np.zeros(width, t.dtype)], width)
    same = np.zeros(len(order) + 1, bool)
    for k in range(1, len(order), 4096):
        a, b = order[k - 1 : k + 4095], order[k : k + 4096]
        same[k : k + len(b)] = (view[a[: len(b)]] == view[b]).all(1)
    hit = np.zeros(len(t) + 1, bool)
    hit[order] = same[:-1] | same[1:]
    return hit[starts]


# -- contexts of a group ---------------------------------------------------------------------------


class Contexts:
    """Contexts: group key, bytes before the gram (nearest first) and after it, how many there are, and whether there is an equal."""

    FIELDS = ("g", "left", "right", "a", "b", "base", "full", "key", "pos")

    def __init__(self, **columns: np.ndarray) -> None:
        self.__dict__.update(columns)

    def __len__(self) -> int:
        return len(self.g)

    @property
    def side(self) -> int:
        return self.left.shape[1]

    def take(self, i: np.ndarray) -> Contexts:
        return Contexts(**{f: getattr(self, f)[i] for f in self.FIELDS})

    def narrowed(self, side: int) -> Iterator[Contexts]:
        """The same windows, dealt by range of distance: contexts of a smaller side whose keys hold what the range has in common."""
        for x in range(0, self.side, side):
            y = min(x + side, self.side)
            ok = np.flatnonzero((self.a >= x) & (self.b >= self.side - y))
            if not len(ok):
                continue
            core = np.concatenate([self.left[ok, :x], self.right[ok, : self.side - y]], axis=1)
            power = _power(core.shape[1] + 1)[0][1:]
            g = mix(mix(self.g[ok] + np.uint64((x + 1) * int(_ODD) % (1 << 64))) ^ (_SPREAD[core] * power[None, : core.shape[1]]).sum(1, dtype=np.uint64))
            yield Contexts(
                g=g,
                left=self.left[ok, x:y],
                right=self.right[ok, self.side - y : self.side - x],
                a=np.minimum(self.a[ok] - x, y - x),
                b=np.minimum(self.b[ok] - (self.side - y), y - x),
                base=self.base[ok] + x,
                full=self.full[ok],
                key=self.key[ok],
                pos=self.pos[ok],
            )


def solve(c: Contexts) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(key, first, last)``: starts, first to last, of windows of single contexts that another context has too."""
    if not len(c):
        return
    c = c.take(np.argsort(c.g, kind="stable"))
    cuts = np.flatnonzero(np.r_[True, c.g[1:] != c.g[:-1], True])
    least = max(2, LETTERS // (2 * c.side + 2))
    i = 0
    while i < len(cuts) - 1:
        j = i + 1
        while j < len(cuts) - 1 and cuts[j + 1] - cuts[i] <= least and j - i < 1 << 15:
            j += 1
        rows = np.arange(cuts[i], cuts[j])
        if len(rows) > least and c.side > 1:
            for part in c.take(rows).narrowed(max(1, c.side // NARROW)):
                yield from solve(part)
        else:
            yield from _sorted(c.take(rows))
        i = j


def _sorted(c: Contexts) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    n, w = len(c), c.side
    group = np.unique(c.g, return_inverse=True)[1]
    t = np.zeros((n, 2 * w + 2), np.int32)
    far = np.arange(w, 0, -1)  # distance from the gram
    t[:, :w] = np.where(far[None, :] <= c.a[:, None], c.left[:, ::-1].astype(np.int32) + 1, 0)
    t[:, w] = 257 + group
    t[:, w + 1 : 2 * w + 1] = np.where(np.arange(w)[None, :] < c.b[:, None], c.right.astype(np.int32) + 1, 0)
    delta = np.arange(w, -1, -1)  # place w - delta: the window that starts delta before the gram
    valid = (delta[None, :] <= c.a[:, None]) & (w - delta[None, :] <= c.b[:, None])
    row, at = np.nonzero(valid)
    if not len(row):
        return
    hit = np.zeros((n, w + 2), bool)
    hit[row, at] = repeated_windows(t.ravel(), row * (2 * w + 2) + at, w + 1)
    hit[c.full] = False  # those are gone already
    edge = np.diff(np.concatenate([np.zeros((n, 1), bool), hit], axis=1).astype(np.int8), axis=1)
    r0, first = np.nonzero(edge == 1)
    r1, last = np.nonzero(edge == -1)
    begin = c.pos[r0] - c.base[r0] - w
    yield c.key[r0], begin + first, begin + last - 1


# -- grams -----------------------------------------------------------------------------------------


def _slide(x: np.ndarray, w: int, op, neutral: np.uint64) -> np.ndarray:
    """op over x[i : i + w] for each i."""
    y = np.full(-(-len(x) // w) * w + w, neutral, np.uint64)
    y[: len(x)] = x
    blocks = y.reshape(-1, w)
    ahead = op.accumulate(blocks, axis=1).ravel()
    behind = op.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return op(behind[: len(x)], ahead[w - 1 : w - 1 + len(x)])


def _prefix(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    power, inverse = _power(len(raw) + 1)
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_SPREAD[raw] * power[: len(raw)], out=total[1:])
    return total, inverse


def grams(raw: np.ndarray, at: np.ndarray, sums: tuple[np.ndarray, np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(document, place, hash, context hash, bytes ahead and behind)`` of the grams that are least in a window."""
    none = np.zeros(0, np.int64)
    if len(raw) < LENGTH:
        return none, none, none.astype(np.uint64), none.astype(np.uint64), none.reshape(0, 2)
    total, inverse = sums or _prefix(raw)
    m = len(raw) - GRAM + 1
    end = np.repeat(at[1:], np.diff(at))[:m]
    place = np.arange(m)
    h = mix((total[GRAM:] - total[:m]) * inverse[:m]) & ~np.uint64(1)
    h[place + GRAM > end] = _TOP
    low = _slide(h, SIDE + 1, np.minimum, _TOP)
    low[place + LENGTH > end] = 0
    high = _slide(np.ascontiguousarray(low[::-1]), SIDE + 1, np.maximum, np.uint64(0))[::-1]
    p = np.flatnonzero((h == high) & (high > 0))
    doc = np.searchsorted(at, p, "right") - 1
    ctx, a, b = contexts_at(total, inverse, p, at[doc], at[doc + 1])
    return doc, p - at[doc], h[p], ctx, np.stack([a, b], 1)


def contexts_at(total: np.ndarray, inverse: np.ndarray, p: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of the context at each place, and the bytes that it has before and after the gram."""
    a, b = np.minimum(SIDE, p - begin), np.minimum(SIDE, end - p - GRAM)
    first, last = p - a, p + GRAM + b
    return mix(mix((total[last] - total[first]) * inverse[first]) + a.astype(np.uint64) * _ODD + b.astype(np.uint64)), a, b


def runs(raw: np.ndarray, at: np.ndarray, sums: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """``(document, hash)`` of the runs of RUN words that are least of RUNS neighbours, each once for a document."""
    start, end, first = words(raw, at)
    m = len(start) - RUN + 1
    if m < RUNS:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    total, inverse = sums
    word = mix((total[end] - total[start]) * inverse[start] + (end - start).astype(np.uint64))
    power, back = _power(len(word) + 1)
    along = np.zeros(len(word) + 1, np.uint64)
    np.cumsum(word * power[: len(word)], out=along[1:])
    place = np.arange(m)
    last = np.repeat(first[1:], np.diff(first))[:m]
    h = mix((along[RUN:] - along[:m]) * back[:m]) | np.uint64(1)
    h[place + RUN > last] = _TOP
    low = _slide(h, RUNS, np.minimum, _TOP)
    low[place + RUN + RUNS - 1 > last] = 0
    high = _slide(np.ascontiguousarray(low[::-1]), RUNS, np.maximum, np.uint64(0))[::-1]
    p = np.flatnonzero((h == high) & (high > 0))
    doc, h = np.searchsorted(first, p, "right") - 1, h[p]
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    once = np.r_[True, (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])][: len(doc)]
    return doc[once], h[once]


PACK = "bucket int, kind int, n int, body binary"


def _packed(buckets: np.ndarray, count: int, kind: int, columns: list[np.ndarray]) -> Iterator[tuple[int, int, int, bytes]]:
    """One row for each bucket: the columns' bytes one after another."""
    order = np.argsort(buckets, kind="stable")
    cuts = np.searchsorted(buckets[order], np.arange(count + 1))
    columns = [c[order] for c in columns]
    for k in range(count):
        i, j = cuts[k], cuts[k + 1]
        if j > i:
            yield k, kind, int(j - i), b"".join(np.ascontiguousarray(c[i:j]).tobytes() for c in columns)


def _unpacked(body: bytes, n: int, kinds: list) -> list[np.ndarray]:
    out, spot = [], 0
    for k in kinds:
        dtype, wide = k if isinstance(k, tuple) else (k, 1)
        size = np.dtype(dtype).itemsize * n * wide
        x = np.frombuffer(body, dtype, n * wide, spot)
        out.append(x.reshape(n, wide) if isinstance(k, tuple) else x)
        spot += size
    return out


def _pack_batch(rows: list[tuple[int, int, int, bytes]]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True))
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["bucket", "kind", "n", "body"])


GRAM_KINDS, SPAN_KINDS, RUN_KINDS = [np.uint64, np.int64, np.int32], [np.int64, np.int32, np.int32], [np.uint64, np.int64, np.int32]
PASSAGES = -1  # in place of a span's last start: the row counts passages


def _spans(key, pos, a, b) -> list[np.ndarray]:
    """All windows of contexts: key, first start, last start; those with none are left out."""
    first, last = pos - a, pos - (SIDE - b)
    ok = last >= first
    return [key[ok].astype(np.int64), first[ok].astype(np.int32), last[ok].astype(np.int32)]


def _find_grams(count: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        taken: list[tuple] = []
        size = 0

        def out() -> Iterator[pa.RecordBatch]:
            rows = []
            if held:
                key, pos, h, ctx, ab = (np.concatenate(x) for x in zip(*held, strict=True))
                both = mix(h ^ (ctx * _ODD))
                _, first, inverse, times = np.unique(both, return_index=True, return_inverse=True, return_counts=True)
                again = times[inverse] > 1
                # the same text's same place, once
                spans = np.unique(np.stack(_spans(key[again], pos[again], ab[again, 0], ab[again, 1]), 1), axis=0)
                by_key = (mix(spans[:, 0].astype(np.uint64)) % np.uint64(count)).astype(np.int64)
                rows += _packed(by_key, count, 1, [spans[:, 0], spans[:, 1].astype(np.int32), spans[:, 2].astype(np.int32)])
                h0 = h[first] | (times > 1).astype(np.uint64)  # the last bit: there are equals already
                rows += _packed(((h[first] >> np.uint64(8)) % np.uint64(count)).astype(np.int64), count, 0, [h0, key[first], pos[first].astype(np.int32)])
            if taken:
                key, h = (np.concatenate(x) for x in zip(*taken, strict=True))
                h, key, times = _counted(h, key, np.ones(len(h), np.int64))
                rows += _packed(((h >> np.uint64(8)) % np.uint64(count)).astype(np.int64), count, 2, [h, key, times.astype(np.int32)])
            if rows:
                yield _pack_batch(rows)

        for batch in batches:
            keys = batch.column(0).to_numpy()
            for i, raw, at in slices(batch.column(1)):
                sums = _prefix(raw)
                doc, pos, h, ctx, ab = grams(raw, at, sums)
                if len(doc):
                    held.append((keys[i + doc], pos, h, ctx, ab))
                owner, run_hash = runs(raw, at, sums)
                if len(owner):
                    taken.append((keys[i + owner], run_hash))
                size += len(doc) + len(owner)
                if size > 1 << 20:
                    yield from out()
                    held, taken, size = [], [], 0
        yield from out()

    return run


def _counted(h: np.ndarray, key: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs of hash and key, in this order, and the sum of their times."""
    order = np.lexsort((key, h))
    h, key, times = h[order], key[order], times[order]
    lead = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (key[1:] != key[:-1])])
    return h[lead], key[lead], np.add.reduceat(times, lead)


PLACES = "key long, pos int, h long, multi boolean, last int"


def _places(key, pos, h, multi, last) -> pa.RecordBatch:
    n = len(key)
    columns = [(key, pa.int64()), (pos, pa.int32()), (h, pa.int64()), (multi, pa.bool_()), (last, pa.int32())]
    return pa.RecordBatch.from_arrays([pa.nulls(n, kind) if x is None else pa.array(x, kind) for x, kind in columns], names=["key", "pos", "h", "multi", "last"])


def _repeated_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places of grams that occur twice or more; the number of each text's runs that several documents have; spans found already are handed on."""
    parts, taken = [], []
    for b in batches:
        for kind, n, body in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3), strict=True):
            if kind == 0:
                parts.append(_unpacked(body.as_py(), n, GRAM_KINDS))
            elif kind == 2:
                taken.append(_unpacked(body.as_py(), n, RUN_KINDS))
            else:
                key, first, last = _unpacked(body.as_py(), n, SPAN_KINDS)
                yield _places(key, first, None, None, last)
    if taken:
        h, key, docs = _counted(*(np.concatenate(x) for x in zip(*taken, strict=True)))
        taken = []
        lead = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
        several = np.repeat(np.add.reduceat(docs, lead) > 1, np.diff(np.r_[lead, len(h)]))
        key, n = np.unique(key[several], return_counts=True)
        yield _places(key, n.astype(np.int32), None, None, np.full(len(key), PASSAGES, np.int32))
    if parts:
        h, key, pos = (np.concatenate(x) for x in zip(*parts, strict=True))
        # copies of a text bring the same place more than once; a mark on one of them is kept
        order = np.lexsort((~h, pos, key, h >> np.uint64(1)))
        h, key, pos = h[order], key[order], pos[order]
        bare = h & ~np.uint64(1)
        once = np.r_[True, (bare[1:] != bare[:-1]) | (key[1:] != key[:-1]) | (pos[1:] != pos[:-1])]
        h, key, pos, bare = h[once], key[once], pos[once], bare[once]
        _, inverse, times = np.unique(bare, return_inverse=True, return_counts=True)
        ok = times[inverse] > 1
        yield _places(key[ok], pos[ok], bare[ok].view(np.int64), (h[ok] & np.uint64(1)) == 1, None)


CONTEXT_KINDS = [np.uint64, np.uint64, np.int64, np.int32, np.int32, np.int32, np.uint8]


def _find_contexts(count: int):
    """(key, text, places) -> contexts by hash of their gram."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = []
            places = batch.column(2)
            for i, raw, at in slices(batch.column(1)):
                total, inverse = _prefix(raw)
                for k in range(len(at) - 1):
                    own = places[i + k].values
                    p = own.field("pos").to_numpy().astype(np.int64)
                    h = own.field("h").to_numpy().view(np.uint64)
                    ctx, a, b = contexts_at(total, inverse, p + at[k], np.int64(at[k]), np.int64(at[k + 1]))
                    key, multi = np.full(len(p), batch.column(0)[i + k].as_py(), np.int64), own.field("multi").to_numpy(zero_copy_only=False)
                    held.append((h, ctx, key, *(x.astype(np.int32) for x in (p, a, b)), multi.astype(np.uint8)))
            if held:
                cols = [np.concatenate(x) for x in zip(*held, strict=True)]
                yield _pack_batch(list(_packed(((cols[0] >> np.uint64(8)) % np.uint64(count)).astype(np.int64), count, 0, cols)))

    return run


def _mixed_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contexts by gram -> spans of those that have an equal, and one place of each distinct context of a group that needs sorting.

    ``multi`` is null for a span; else whether the context has an equal.  ``last`` of a place is its number of contexts, for a group to be dealt by narrow ranges, else 0.
    """
    parts = [_unpacked(body.as_py(), n, CONTEXT_KINDS) for b in batches for n, body in zip(b.column(2).to_pylist(), b.column(3), strict=True)]
    if not parts:
        return
    h, ctx, key, pos, a, b, multi = (np.concatenate(x) for x in zip(*parts, strict=True))
    both = mix(h ^ (ctx * _ODD))
    order = np.lexsort((pos, key, both, h))
    h, both, key, pos, a, b, multi = (x[order] for x in (h, both, key, pos, a, b, multi))
    fresh = np.r_[True, (h[1:] != h[:-1]) | (both[1:] != both[:-1])]
    new_place = np.r_[True, fresh[1:] | (key[1:] != key[:-1]) | (pos[1:] != pos[:-1])]
    lead = np.flatnonzero(fresh)
    sizes = np.diff(np.r_[lead, len(h)])
    full = (np.add.reduceat(new_place.astype(np.int64), lead) > 1) | (np.maximum.reduceat(multi, lead) > 0)
    spread = np.repeat(full, sizes) & new_place
    yield _places(*(lambda k, f, l: (k, f, None, None, l))(*_spans(key[spread], pos[spread], a[spread], b[spread])))
    groups, inverse, distinct = np.unique(h[lead], return_inverse=True, return_counts=True)
    single = np.zeros(len(groups), bool)
    single[inverse[~full]] = True
    ok = (distinct[inverse] > 1) & single[inverse]
    wide = np.where(distinct[inverse] * (2 * SIDE + 2) > LETTERS, distinct[inverse], 0)
    pick = lead[ok]
    yield _places(key[pick], pos[pick], h[pick].view(np.int64), full[ok], np.minimum(wide[ok], 2**31 - 1).astype(np.int32))


def _item_kinds(side: int) -> list:
    return [np.uint64, (np.uint8, side), (np.uint8, side), np.int32, np.int32, np.int32, np.uint8, np.int64, np.int32]


def _rows_of(c: Contexts, count: int, kind: int) -> list:
    buckets = (mix(c.g) % np.uint64(count)).astype(np.int64)
    distances = [x.astype(np.int32) for x in (c.a, c.b, c.base)]
    return list(_packed(buckets, count, kind, [c.g, c.left, c.right, *distances, c.full.astype(np.uint8), c.key, c.pos.astype(np.int32)]))


def _cut_contexts(count: int):
    """(key, text, places) -> contexts with their bytes, packed by group; kind is their side."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = batch.column(2)
            for i, raw, at in slices(batch.column(1)):
                g, p, full, wide, key, begin, end = [], [], [], [], [], [], []
                for k in range(len(at) - 1):
                    own = places[i + k].values
                    n = len(own)
                    p.append(own.field("pos").to_numpy().astype(np.int64) + at[k])
                    g.append(own.field("h").to_numpy().view(np.uint64))
                    full.append(own.field("multi").to_numpy(zero_copy_only=False).astype(bool))
                    wide.append(own.field("last").to_numpy() > 0)
                    key.append(np.full(n, batch.column(0)[i + k].as_py(), np.int64))
                    begin.append(np.full(n, at[k]))
                    end.append(np.full(n, at[k + 1]))
                g, p, full, wide, key, begin, end = (np.concatenate(x) for x in (g, p, full, wide, key, begin, end))
                a, b = np.minimum(SIDE, p - begin), np.minimum(SIDE, end - p - GRAM)
                padded = np.r_[np.zeros(SIDE, np.uint8), raw, np.zeros(SIDE + GRAM, np.uint8)]
                left = padded[(p + SIDE)[:, None] - np.arange(1, SIDE + 1)[None, :]]
                right = padded[(p + SIDE + GRAM)[:, None] + np.arange(SIDE)[None, :]]
                left[np.arange(SIDE)[None, :] >= a[:, None]] = 0
                right[np.arange(SIDE)[None, :] >= b[:, None]] = 0
                c = Contexts(g=g, left=left, right=right, a=a, b=b, base=np.zeros(len(g), np.int64), full=full, key=key, pos=p - begin)
                rows = _rows_of(c.take(np.flatnonzero(~wide)), count, SIDE)
                if wide.any():
                    for part in c.take(np.flatnonzero(wide)).narrowed(NARROW):
                        rows += _rows_of(part, count, part.side)
                if rows:
                    yield _pack_batch(rows)

    return run


def _sort_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts: dict[int, list] = {}
    for b in batches:
        for side, n, body in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3), strict=True):
            parts.setdefault(side, []).append(_unpacked(body.as_py(), n, _item_kinds(side)))
    for rows in parts.values():
        cols = dict(zip(Contexts.FIELDS, (np.concatenate(x) for x in zip(*rows, strict=True)), strict=True))
        cols["full"] = cols["full"].astype(bool)
        for f in ("a", "b", "base", "pos"):
            cols[f] = cols[f].astype(np.int64)
        for key, first, last in solve(Contexts(**cols)):
            yield _places(key, first.astype(np.int32), None, None, last.astype(np.int32))


# -- documents -------------------------------------------------------------------------------------


def _cut_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(sha, text, spans) -> what is left of each text."""
    for batch in batches:
        out = []
        for sha, text, spans in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
            data = text.as_py().encode()
            first, last = spans.values.field("pos").to_numpy(), spans.values.field("last").to_numpy()
            order = np.argsort(first, kind="stable")
            first, until = first[order], np.maximum.accumulate(last[order] + LENGTH)
            new = np.flatnonzero(np.r_[True, first[1:] > until[:-1]])
            begins, ends = first[new], until[np.r_[new[1:] - 1, len(until) - 1]]
            kept, spot = hashlib.sha256(), 0
            for x, y in zip(begins.tolist(), ends.tolist(), strict=True):
                kept.update(data[spot:x])
                spot = y
            kept.update(data[spot:])
            out.append((sha, int((ends - begins).sum()), len(begins), kept.hexdigest(), [{"begin": int(x), "end": int(y)} for x, y in zip(begins, ends, strict=True)]))
        if out:
            cols = list(zip(*out, strict=True))
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))]
            arrays = [pa.array(c, k) for c, k in zip(cols, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=["sha", "n_removed", "n_spans", "kept_sha256", "spans"])


def repeated(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", buckets: int | None = None) -> DataFrame:
    """``(id, n_bytes, n_removed, n_spans, kept_sha256, spans, n_passages)``: what of each row's text repeats, as byte ranges.

    ``n_passages``: how many of the runs of words taken from the text other documents have too; none means that there is no
    passage of over 50 words in common.
    """
    spark = docs.sparkSession
    count = buckets or max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"))
    keyed = rows.select(F.xxhash64("text").alias("key"), "text")
    long = keyed.where(F.octet_length("text") >= LENGTH)
    worded = keyed.where(F.octet_length("text") >= 2 * (RUN + RUNS - 1) - 1)  # room for that many words
    deal = lambda df, f, schema: df.repartition(count, "bucket").mapInArrow(f, schema)
    found = stage(deal(worded.mapInArrow(_find_grams(count), PACK), _repeated_grams, PLACES), "grams")
    own = found.where("h IS NOT NULL").groupBy("key").agg(F.collect_list(F.struct("pos", "h", "multi")).alias("places"))
    # every text that has a span found already has a place too, or is found through its spans
    spans_found = found.where(f"h IS NULL AND last <> {PASSAGES}")
    touched = spans_found.select("key").distinct().join(own, "key", "full_outer")
    places = F.coalesce("places", F.array().cast("array<struct<pos:int,h:long,multi:boolean>>")).alias("places")
    # one row for each text: copies are combined before the shuffle, so many of them make no task large
    distinct = long.groupBy("key").agg(F.collect_set("text").alias("texts"))
    texts = stage(distinct.join(touched, "key").select("key", F.explode("texts").alias("text"), places), "texts")
    some = texts.where("size(places) > 0").select("key", "text", "places")
    mixed = stage(deal(some.mapInArrow(_find_contexts(count), PACK), _mixed_groups, PLACES), "contexts")
    cut = mixed.where("multi IS NOT NULL").groupBy("key").agg(F.collect_list(F.struct("pos", "h", "multi", "last")).alias("cuts"))
    cutting = texts.select("key", "text").join(cut, "key").select("key", "text", "cuts")
    sorted_ = stage(deal(cutting.mapInArrow(_cut_contexts(count), PACK), _sort_groups, PLACES), "sorted")
    spans = spans_found.unionByName(mixed.where("multi IS NULL")).unionByName(sorted_).select("key", "pos", "last")
    spans = spans.groupBy("key").agg(F.collect_set(F.struct("pos", "last")).alias("spans"))
    by_text = texts.select("key", "text").join(spans, "key").select(F.sha2("text", 256).alias("sha"), "text", "spans")
    schema = "sha string, n_removed long, n_spans long, kept_sha256 string, spans array<struct<begin:int,end:int>>"
    parts = stage(by_text.mapInArrow(_cut_texts, schema).dropDuplicates(["sha"]), "cut")
    passages = found.where(f"last = {PASSAGES}").groupBy("key").agg(F.sum("pos").alias("n_passages"))
    all_rows = rows.select("id", F.octet_length("text").cast("long").alias("n"), F.sha2("text", 256).alias("sha"), F.xxhash64("text").alias("key"))
    copies = all_rows.groupBy("sha").agg(F.count("*").alias("copies"), F.first("key").alias("key"))
    # a table of its own: a join of two exchanges, which the optimiser can split where many rows have one text
    known = stage(copies.join(parts, "sha", "left").join(passages, "key", "left").drop("key"), "known")
    drop(found, texts, mixed, sorted_)
    out = all_rows.drop("key").join(known, "sha")
    gone = (F.col("copies") > 1) & (F.col("n") >= LENGTH)
    whole = F.array(F.struct(F.lit(0).alias("begin"), F.col("n").cast("int").alias("end")))
    none = F.array().cast("array<struct<begin:int,end:int>>")
    return out.select(
        "id",
        F.col("n").alias("n_bytes"),
        F.when(gone, F.col("n")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(gone, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(gone, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
        F.when(gone, whole).otherwise(F.coalesce("spans", none)).alias("spans"),
        F.coalesce("n_passages", F.lit(0)).cast("long").alias("n_passages"),
    )


def op6_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    """Query: of every document the bytes that repeat, and the digest of the rest; and whether any passage repeats, the shorter ones included."""
    found = repeated(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("spans").withColumnRenamed("id", "doc_id")
    return found.withColumn("repeats", (F.col("n_removed") > 0) | (F.col("n_passages") > 0))
