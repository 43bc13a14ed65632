"""Near-duplicate passages by compact windows.

A text is its sequence of hashed five-word shingles. For each of a few hash functions the Cartesian
tree over the hashes yields compact windows (l, c, r): every passage that begins in [l, c] and ends in
[c, r] has its minimum at c, so all those passages share one signature. Only windows that hold a
passage of ``MIN_WORDS`` words matter; these are the minima of the sliding windows of that width, about
2 per width and hash.

Windows of equal minima meet by a shuffle on the minimum. Each is linked to the first of them (smallest
document), so a group of n costs n - 1 links, never n^2; a window whose content another text of its batch
holds in full goes as a link to it. Windows that the first need not stand for meet again, in a second
shuffle, under finer keys: their minimum with the least shingle of the half before, of the half after
and of both, and all their passages of just the width, each under its whole content. So equal passages
meet, however often their shingles occur elsewhere; similar ones share some key with a good chance.
Links whose windows overlap by enough, around the same place, are joined to intervals per (text, first
text, shift). The shingles of every block's best-supported interval are fetched and compared first, then
those of all other intervals but such as lie in a passage found with a text that is itself linked to
their partner: a passage counts if it has at least ``MIN_WORDS`` words and the Jaccard similarity of its
shingles with the other's is at least ``SIMILARITY``.

Shingles are cut and hashed once per text; what is fetched and compared of them are ``CODE`` bytes each. Two different
shingles of a pair of passages of 100 words agree in them by chance in fewer than one pair in 10^8.

Equal texts are one text here: copies are told by a 64-bit hash and MD5 together, reported as such and not
expanded into pairs. Passages know their text by the 64-bit hash alone: two texts that share it by chance
are not searched for passages of each other.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from tessera.llm.components import connected_components
from tessera.llm.workspace import Workspace

SHINGLE = 5
MIN_WORDS = 50
SIMILARITY = 0.8
HASHES = 4
GRID = 64  # fetched intervals begin and end at multiples of it, so that links to one text share fetches
BLOCK = 256  # words; links of a text are gathered per block of it
SLACK = 16  # words fetched beyond an interval, where windows cut by a changed word may still match
CODE = 5  # bytes of a shingle's hash that are compared
WORD = r"[^\x20\x09-\x0D]+"


def mix(x: np.ndarray) -> np.ndarray:
    """An avalanching bijection of 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


P1, P2, P3, P4, P5 = (np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))  # of XXH64


def rotated(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def short_hashes(eights: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """XXH64 (seed 0) of the ``size`` bytes, under 32, from each place; ``eights`` has the 8 bytes from every place."""
    h, read = np.full(len(at), P5 + np.uint64(size)), 0
    while size - read >= 8:
        h ^= rotated(eights[at + read].view(np.uint64) * P2, 31) * P1
        h = rotated(h, 27) * P1 + P4
        read += 8
    tail = eights[at + read].view(np.uint64) if read < size else h
    if size - read >= 4:
        h ^= (tail & np.uint64(0xFFFFFFFF)) * P1
        h = rotated(h, 23) * P2 + P3
        tail, read = tail >> np.uint64(32), read + 4
    while read < size:
        h ^= (tail & np.uint64(0xFF)) * P5
        h = rotated(h, 11) * P1
        tail, read = tail >> np.uint64(8), read + 1
    h = (h ^ (h >> np.uint64(33))) * P2
    h = (h ^ (h >> np.uint64(29))) * P3
    return h ^ (h >> np.uint64(32))


def word_hashes(texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash of every word, XXH64 of its UTF-8; bounds of each text in it)."""
    import xxhash

    texts = texts.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = np.frombuffer(data or b"", np.uint8)[offsets[0]:offsets[-1]]
    offsets = offsets - offsets[0]
    if not len(raw):
        return np.empty(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    word = (raw != 0x20) & (raw - np.uint8(9) > 4)
    opens, closes = word.copy(), word.copy()
    opens[1:] &= ~word[:-1]
    closes[:-1] &= ~word[1:]
    edge = offsets[(offsets > 0) & (offsets < len(raw))]  # a text's last word and the next one's first may touch
    opens[edge], closes[edge - 1] = word[edge], word[edge - 1]
    at = np.flatnonzero(opens)
    size = np.flatnonzero(closes) + 1 - at
    out = np.empty(len(at), np.uint64)
    padded = np.concatenate((raw, np.zeros(8, np.uint8)))
    eights = np.ndarray(len(raw) + 1, "V8", padded, 0, (1,))
    order = np.argsort(np.minimum(size, 32).astype(np.uint8), kind="stable")
    stop = np.searchsorted(size[order[: np.count_nonzero(size < 32)]], np.arange(1, 33)).tolist()
    for n, (i, j) in enumerate(zip(stop, stop[1:], strict=False), 1):
        if i < j:
            out[order[i:j]] = short_hashes(eights, at[order[i:j]], n)
    for k in order[stop[-1]:].tolist():
        out[k] = xxhash.xxh64_intdigest(raw[at[k]:at[k] + size[k]])
    return out, np.searchsorted(at, offsets)


def shingle_hashes(words: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Hash of words[i : i + size] for every i that has so many."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out = out * np.uint64(0x9E3779B97F4A7C15) + words[k:k + n]
    return mix(out)


def sliding(x: np.ndarray, width: int, pick) -> np.ndarray:
    """pick over x[i : i + width] for every i, in about log2(width) passes."""
    have, out = 1, x
    while have < width:
        step = min(have, width - have)
        out = pick(out[: len(out) - step], out[step:])
        have += step
    return out


def window_minima(g: np.ndarray, text: np.ndarray, width: int) -> np.ndarray:
    """Positions that are the minimum of some ``width`` consecutive hashes of one text (number in ``text``)."""
    if len(g) < width:
        return np.empty(0, np.int64)
    low = sliding(g, width, np.minimum)
    low[text[: len(low)] != text[width - 1:]] = 0
    padded = np.concatenate((np.zeros(width - 1, np.uint64), low, np.zeros(width - 1, np.uint64)))
    return np.flatnonzero(sliding(padded, width, np.maximum) == g)


def reaches(g, at, first, last) -> tuple[np.ndarray, np.ndarray]:
    """How far each of the minima reaches to both sides before a smaller hash, as in the Cartesian tree.

    The nearest smaller hash of a minimum is itself a minimum of some window, so the minima suffice. Each looks
    at its neighbour and, while that is larger, on at the place the neighbour looks at: all between are larger.
    """
    g, at, first, last = (np.asarray(x) for x in (g, at, first, last))
    n = len(g)
    text = np.cumsum(np.concatenate((np.zeros(min(n, 1), np.int64), first[1:] != first[:-1])))  # a wall before and after each text
    here = np.arange(n) + text + 1
    value = np.zeros(n + (int(text[-1]) + 2 if n else 1), np.uint64)
    value[here] = g
    place = np.zeros(len(value), np.int64)
    place[here] = at
    out = []
    for step, beyond in ((-1, np.greater), (1, np.greater_equal)):  # of equal hashes the earlier one reaches over the later
        to = np.arange(len(value)) + step
        todo = here[beyond(value[to[here]], value[here])]
        while len(todo):
            to[todo] = to[to[todo]]
            todo = todo[beyond(value[to[todo]], value[todo])]
        end = to[here]
        out.append(np.where(value[end] > 0, place[end] - step, first if step < 0 else last))
    return out[0], out[1]


def first_of_cluster(g: np.ndarray, doc: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """Places of the minima that no equal minimum of the same text precedes within ``width``.

    Equal hashes close together are one repeating shingle; the first one's window reaches over the others.
    """
    order = np.lexsort((at, g, doc))
    again = (doc[order][1:] == doc[order][:-1]) & (g[order][1:] == g[order][:-1]) & (np.diff(at[order]) < width)
    return np.sort(order[np.concatenate((np.ones(min(1, len(order)), bool), ~again))])


def by_bytes(batches: Iterator[pa.RecordBatch], column: int, limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``limit`` bytes of a text column, which bounds a task's memory."""
    for b in batches:
        size = np.concatenate(([0], np.cumsum(pc.binary_length(b.column(column)).to_numpy().astype(np.int64))))
        at = 0
        while at < b.num_rows:
            stop = max(at + 1, int(np.searchsorted(size, size[at] + limit, side="right")) - 1)
            yield b.slice(at, stop - at)
            at = stop


WINDOWS = ["key", "ord", "u", "c", "left", "right", "ctx", "r_ord", "r_u", "r_c"]
OWN = 7  # columns of a window; the others are null until it is linked
STEP = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2^64


def shingled(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(shingles, row of each, first shingle of each row, number of each row's shingles) of (ord, u, text, ..) rows."""
    words, bounds = word_hashes(batch.column(2))
    s = shingle_hashes(words)
    number = np.repeat(np.arange(batch.num_rows), np.diff(bounds))[: len(s)]
    ends = np.maximum(bounds[1:] - SHINGLE, bounds[:-1] - 1)  # last shingle of each text
    inside = np.arange(len(s)) <= ends[number] if len(s) else np.empty(0, bool)
    s, number = s[inside], number[inside]
    size = np.bincount(number, minlength=batch.num_rows) if len(s) else np.zeros(batch.num_rows, np.int64)
    return s, number, np.cumsum(size) - size, size


def content_hashes(s: np.ndarray):
    """A function (from, to) -> hashes of s[from:to], for arrays of places."""
    def powers(x):
        return np.multiply.accumulate(np.concatenate((np.ones(1, np.uint64), np.full(len(s), x, np.uint64))))

    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(s * powers(STEP)[:-1], dtype=np.uint64)))
    back = powers(pow(STEP, -1, 1 << 64))
    return lambda a, b: mix((sums[b] - sums[a]) * back[a] ^ mix((b - a).astype(np.uint64)))


def compact_windows(batch: pa.RecordBatch, width: int, hashes: int) -> list[np.ndarray]:
    """Columns key, ord, u, c, left, right, ctx of all windows of a batch of (ord, u, text) rows.

    ``ctx`` is the content of a window, as far as passages of ``width`` around the minimum reach: of two
    windows with equal ones, every such passage of one is a passage of the other. The last bits of
    ``key`` are the number of the hash function.
    """
    s, number, start, size = shingled(batch)
    ord_, u = batch.column(0).to_numpy(), batch.column(1).to_numpy()
    content = content_hashes(s)
    out = []
    for f in range(hashes):
        g = mix(s ^ mix(np.uint64(f + 1) * np.full(1, STEP, np.uint64)))
        g[g == 0] = 1
        at = window_minima(g, number, width)
        doc = number[at]
        left, right = reaches(g[at], at, start[doc], start[doc] + size[doc] - 1)
        once = first_of_cluster(g[at], doc, at, width)
        doc, at, left, right = doc[once], at[once], left[once], right[once]
        begin, end = np.maximum(left, at - width + 1), np.minimum(right, at + width - 1) + 1
        ctx = mix(content(begin, end) ^ (at - begin).astype(np.uint64))
        key = g[at] & ~np.uint64(3) | np.uint64(f & 3)
        out.append([key.view(np.int64), ord_[doc], u[doc], at - start[doc], at - left, right - at, ctx.view(np.int64)])
    return [np.concatenate(x) for x in zip(*out, strict=True)]


def overlap(left, right, r_left, r_right):
    return np.minimum(left, r_left), np.minimum(right, r_right)


def _links(cols, lead, member, width):
    """Link columns of members whose windows overlap, around the shared minimum, by most of a passage."""
    m = [x[member] for x in cols]
    r = [x[lead[member]] for x in cols]
    lo, hi = overlap(m[4], m[5], r[4], r[5])
    keep = lo + hi + 1 >= width * SIMILARITY
    return [x[keep] for x in (*m[:4], lo, hi, m[6], r[1], r[2], r[3])]


def _batch(cols: list) -> pa.RecordBatch:
    none = [pa.nulls(len(cols[0]), pa.int64())] * (len(WINDOWS) - len(cols))
    return pa.RecordBatch.from_arrays([pa.array(x) for x in cols] + none, names=WINDOWS)


def _runs(cols: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(whether a row opens a run of its key, place of the run's first row) of rows sorted by key."""
    opens = np.concatenate(([True], cols[0][1:] != cols[0][:-1]))
    return opens, np.maximum.accumulate(np.where(opens, np.arange(len(opens)), 0))


def _stands_for(cols: list[np.ndarray], lead: np.ndarray) -> np.ndarray:
    """Rows whose passages are all passages of their run's first row: another text's, or a copy's of the text."""
    other = (cols[2] != cols[2][lead]) | (cols[3] == cols[3][lead])
    return (cols[6] == cols[6][lead]) & other & (lead != np.arange(len(lead)))


def _sent(cols: list[np.ndarray], width: int) -> Iterator[pa.RecordBatch]:
    """The windows of a batch, but those that an equal window stands for go as links to it."""
    order = np.lexsort((cols[3], cols[2], cols[1], cols[0]))
    cols = [x[order] for x in cols]
    _, lead = _runs(cols)
    same = _stands_for(cols, lead)
    yield _batch([x[~same] for x in cols])
    links = _links(cols, lead, same & (cols[2] != cols[2][lead]), width)
    if len(links[0]):  # they pass the shuffle as they are, spread evenly
        links[0] = mix(links[1].view(np.uint64) ^ links[3].view(np.uint64)).view(np.int64)
        yield _batch(links)


def _met(batches: Iterator[pa.RecordBatch], width: int, again: bool) -> Iterator[pa.RecordBatch]:
    """Windows sorted by (key, ord, u, c) -> links to the first of a key; links that are ready pass.

    With ``again`` the windows of a key of three or more that the first does not stand for are handed on
    too: they may match each other. A row of the first row's own text gives no link.
    """
    held, long = [np.empty(0, np.int64)] * OWN, False  # the last run, or its first row if more than two were seen

    def run(cols, first_is_long):
        opens, lead = _runs(cols)
        links = _links(cols, lead, ~opens & (cols[2] != cols[2][lead]), width)
        if len(links[0]):
            yield _batch(links)
        if again:
            size = np.bincount(lead, minlength=len(lead))[lead]
            if first_is_long:
                size[lead == 0] = 3
            rest = (size > 2) & ~opens & ~_stands_for(cols, lead)
            if rest.any():
                yield _batch([x[rest] for x in cols])

    for b in batches:
        done = b.filter(b.column(OWN).is_valid())
        if done.num_rows:
            yield done
        b = b.filter(b.column(OWN).is_null())
        if not b.num_rows:
            continue
        cols = [np.concatenate((h, b.column(k).to_numpy())) for k, h in enumerate(held)]
        _, lead = _runs(cols)
        last = int(lead[-1])
        goes_on = long and last == 0
        if len(lead) - last > 2 or goes_on:
            yield from run(cols, long)
            held, long = [x[last:last + 1] for x in cols], True
        else:
            if last:
                yield from run([x[:last] for x in cols], long)
            held, long = [x[last:] for x in cols], False
    if len(held[0]) > 1:
        yield from run(held, long)


def _contexts(batch: pa.RecordBatch, width: int) -> list[np.ndarray]:
    """Windows under finer keys, from (ord, u, text, asks) rows; ``asks`` lists windows (key, c, left, right, ctx).

    The half of a passage's width before and the half after the minimum: a passage of the full width holds
    one of them, so the least shingle of either, and of both, joins the key. The windows of the first hash
    function are also replaced by all their passages of just the width, each under its whole content:
    equal passages meet whatever else their shingles occur in.
    """
    s, _, start, _ = shingled(batch)
    asks = batch.column(3)
    row = np.repeat(np.arange(len(asks)), pc.list_value_length(asks).to_numpy())
    key, c, left, right, ctx = (x.to_numpy() for x in asks.flatten().flatten())
    ord_, u = batch.column(0).to_numpy()[row], batch.column(1).to_numpy()[row]
    at, half = start[row] + c, max(1, width // 2)
    low = sliding(mix(s ^ np.uint64(STEP)), half, np.minimum)
    before, after = left >= half, right >= half
    sides = [np.zeros(len(key), np.uint64) for _ in range(2)]
    sides[0][before] = low[at[before] - half]
    sides[1][after] = low[at[after] + 1]
    out = []
    for n, (has, side) in enumerate(((before, sides[0]), (after, sides[1]), (before & after, mix(sides[0]) ^ sides[1]))):
        finer = mix(key.view(np.uint64) ^ mix(side ^ np.uint64(n + 1)))
        out.append([x[has] for x in (finer.view(np.int64), ord_, u, c, left, right, ctx)])
    first = (key & 3) == 0
    begin = (at - np.minimum(left, width - 1))[first]
    many = np.minimum(at, at + right - width + 1)[first] - begin + 1
    of = np.repeat(np.flatnonzero(first), many)
    place = np.repeat(begin, many) + np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many)
    place, own = np.unique(place, return_index=True)
    of = of[own]
    whole = content_hashes(s)(place, place + width).view(np.int64)
    zero = np.zeros(len(of), np.int64)
    out.append([whole, ord_[of], u[of], place - start[row[of]], zero, zero + width - 1, whole])
    return [np.concatenate(x) for x in zip(*out, strict=True)]


def passage_links(rows: DataFrame, ws: Workspace, width: int, hashes: int = HASHES) -> DataFrame:
    """(ord, u, text) -> links (ord, u, c, left, right, r_ord, r_u, r_c): equal minima, windows that overlap."""
    schema = ", ".join(f"{c} long" for c in WINDOWS)
    own = ["ord", "u", "c", "left", "right", "r_ord", "r_u", "r_c"]

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in by_bytes(batches, 2):
            cols = compact_windows(b, width, hashes)
            if len(cols[0]):
                yield from _sent(cols, width)

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in by_bytes(batches, 2):
            yield from _sent(_contexts(b, width), width)

    def met(found: DataFrame, again: bool) -> DataFrame:
        found = found.repartition("key").sortWithinPartitions("key", "ord", "u", "c")
        return found.mapInArrow(lambda it: _met(it, width, again), schema)

    links = ws.put(met(rows.select("ord", "u", "text").mapInArrow(windows, schema), True), "links")
    asks = links.filter("r_u is null").groupBy("ord", "u").agg(F.collect_set(F.struct("key", "c", "left", "right", "ctx")).alias("asks"))  # bounded by the text's length
    finer = rows.select("ord", "u", "text").join(asks, ["ord", "u"]).select("ord", "u", "text", "asks")
    finer = ws.put(met(finer.mapInArrow(contexts, schema), False).select(own), "finer")
    return links.filter("r_u is not null").select(own).unionByName(finer)


def in_step(mine_of: np.ndarray, its_of: np.ndarray, other_of: np.ndarray, hit: np.ndarray, near_hit: np.ndarray, first: int, last: int):
    """(start, stop) -> (start in b, stop in b, similarity) within a[first:last] from running counts; None if they don't tell.

    They do where no shingle repeats on either side, all that recur do so nearby and in the same order: then
    every such shingle of a[start:stop] lies between the places of the first and the last of them.
    """
    near = np.flatnonzero(near_hit[first:last]) + first
    its = other_of[near]
    if not len(near) or np.count_nonzero(hit[first:last]) > len(near) or (np.diff(its) <= 0).any():
        return None
    for kinds in (mine_of[first:last], its_of[its[0]:its[-1] + 1]):
        ordered = np.sort(kinds)
        if (ordered[1:] == ordered[:-1]).any():
            return None
    before = np.concatenate(([0], np.cumsum(near_hit[first:last]))).tolist()  # recurring shingles before a place
    its = its.tolist()

    def compared(s, e):
        i, j = before[s - first], before[e - first]
        if i == j:
            return 0, 0, 0.0
        t, w = its[i], its[j - 1] + 1
        return t, w, (j - i) / (e - s + w - t - (j - i))

    return compared


def split(places: np.ndarray, gap: int) -> list[np.ndarray]:
    """Ascending places, cut where the next is more than ``gap`` away."""
    cuts = [0, *(np.flatnonzero(places[1:] - places[:-1] > gap) + 1).tolist(), len(places)]
    return [places[i:j] for i, j in zip(cuts, cuts[1:], strict=False)]


def matching_spans(a: np.ndarray, b: np.ndarray, width: int, shift: int) -> list[tuple[int, int, int, int, float]]:
    """(start, stop, start in b, stop in b, similarity) of passages of shingles ``a`` that recur in ``b``.

    A shingle that occurs at its place plus ``shift`` in b is taken there, others where they first occur.
    """
    found = matching_pairs(a, np.array([0, len(a)]), b, np.array([0, len(b)]), width, np.array([shift]))
    return [x for _, spans in found for x in spans]


def matching_pairs(a: np.ndarray, bounds: np.ndarray, b: np.ndarray, r_bounds: np.ndarray, width: int, shift: np.ndarray):
    """(number, ``matching_spans``) of the pairs a[bounds[k]:bounds[k + 1]], b[r_bounds[k]:r_bounds[k + 1]] that may have any.

    What recurs where is found for all pairs at once; of several pairs shingles have ``CODE`` bytes.
    """
    pairs = len(shift)
    assert pairs <= 1 << 64 - 8 * CODE
    row, r_row = np.repeat(np.arange(pairs), np.diff(bounds)), np.repeat(np.arange(pairs), np.diff(r_bounds))
    wide = np.concatenate((row, r_row)).astype(np.uint64) << np.uint64(8 * CODE)
    kinds, code = np.unique(np.concatenate((a, b)) | wide, return_inverse=True)
    mine_of, its_of = code[: len(a)], code[len(a):]
    first_in, first_of = np.full(len(kinds), -1), np.full(len(kinds), -1)
    first_in[its_of[::-1]] = np.arange(len(b) - 1, -1, -1)
    first_of[mine_of[::-1]] = np.arange(len(a) - 1, -1, -1)
    other_of = first_in[mine_of]
    hit = other_of >= 0
    place, at, to = np.arange(len(a)) - bounds[row], r_bounds[row], shift[row]
    other_of = np.where(hit, other_of - at, -1)
    straight = place + to
    inside = (straight >= 0) & (straight < np.diff(r_bounds)[row])
    inside[inside] = its_of[(straight + at)[inside]] == mine_of[inside]
    other_of[inside] = straight[inside]
    near_hit = hit & (np.abs(other_of - straight) <= SLACK)  # not its repeats elsewhere in b
    again = np.zeros(pairs, bool)  # pairs in which a shingle repeats on a side
    again[row[first_of[mine_of] != np.arange(len(a))]] = True
    again[r_row[first_in[its_of] != np.arange(len(b))]] = True
    # only pairs with enough in common, in a part of the least width without large gaps
    where = np.flatnonzero(hit)
    enough = np.bincount(row[where], minlength=pairs) >= width * SIMILARITY
    opens = np.flatnonzero(np.concatenate((np.ones(min(1, len(where)), bool), (where[1:] - where[:-1] > 3 * SHINGLE) | (row[where][1:] != row[where][:-1]))))
    closes = np.concatenate((opens[1:], np.full(min(1, len(where)), len(where)))) - 1
    parted = np.zeros(pairs, bool)
    parted[row[where[opens]][where[closes] - where[opens] + 1 >= width]] = True
    base = np.searchsorted(kinds, np.arange(pairs).astype(np.uint64) << np.uint64(8 * CODE))
    for k in np.flatnonzero(enough & parted).tolist():
        i, j, r_i, r_j = int(bounds[k]), int(bounds[k + 1]), int(r_bounds[k]), int(r_bounds[k + 1])
        spans = _spans(mine_of[i:j] - base[k], its_of[r_i:r_j] - base[k], other_of[i:j], hit[i:j], near_hit[i:j], inside[i:j], not again[k], width, int(shift[k]))
        if spans:
            yield k, spans


def _spans(mine_of, its_of, other_of, hit, near_hit, inside, once: bool, width: int, shift: int) -> list[tuple[int, int, int, int, float]]:
    """``matching_spans`` of shingles numbered by kind; ``once``: none repeats in a or in b."""
    places = np.flatnonzero(hit)
    kinds = 0 if once else int(max(mine_of.max(), its_of.max())) + 1

    def compared(s, e):
        """(start, stop, similarity) of a[s:e]'s counterpart in b; what is too short counts as unlike."""
        near = other_of[s:e][near_hit[s:e]]
        t, w = (int(near.min()), int(near.max()) + 1) if len(near) else (0, 0)
        if w - t < width * SIMILARITY:
            return t, w, 0.0
        if (t, w) == (s + shift, e + shift) and inside[s:e].all():
            return t, w, 1.0  # word for word
        if once:
            both = np.count_nonzero((other_of[s:e] >= t) & (other_of[s:e] < w))
            return t, w, both / (e - s + w - t - both)
        mine, its = np.zeros(kinds, bool), np.zeros(kinds, bool)
        mine[mine_of[s:e]] = True
        its[its_of[t:w]] = True
        both = np.count_nonzero(mine & its)
        return t, w, both / (np.count_nonzero(mine) + np.count_nonzero(its) - both)

    def counts(t, w, share):
        return share >= SIMILARITY and w - t >= width * SIMILARITY

    spans, todo, weak = [], [places], []
    for gap in (3 * SHINGLE, 2 * SHINGLE, SHINGLE + 1, 1):
        rest = []
        for p in todo:
            for part in split(p, gap):
                if not len(part) or part[-1] - part[0] + 1 < width:
                    continue
                s, e = int(part[0]), int(part[-1]) + 1
                found = compared(s, e)
                if counts(*found):
                    spans.append((s, e, *found))
                else:
                    rest.append(part)
        todo = rest
        weak = weak or rest
    # of parts that are too weak as a whole: the stretches of places at which a passage of the least width has enough in common
    total = np.concatenate(([0], np.cumsum(near_hit))) if weak else None
    for part in weak:
        first, last = int(part[0]), int(part[-1]) + 1
        rich = first + np.flatnonzero(total[first + width:last + 1] - total[first:last + 1 - width] >= width * SIMILARITY)
        todo = split(rich, 1) if len(rich) else []
        quick = in_step(mine_of, its_of, other_of, hit, near_hit, first, last) if todo else None
        known = list(spans)  # a stretch never lies in one found below: those of a part go from right to left
        while todo:
            r = todo.pop()
            s, e = int(r[0]), int(r[-1]) + width
            if quick is None and any(x[0] <= s and e <= x[1] for x in known):
                continue
            found = compared(s, e) if quick is None else quick(s, e)
            if counts(*found):
                if quick is None or not any(x[0] <= s and e <= x[1] for x in known):
                    spans.append((s, e, *found))
            elif len(r) > 1:
                todo += [r[: len(r) // 2], r[len(r) // 2:]]
    return spans


def fetch(rows: DataFrame, wanted: DataFrame, ws: Workspace, name: str) -> DataFrame:
    """(u, ord, s, e) -> (u, ord, s, e, codes): the shingles of words s to e of the text, ``CODE`` bytes of each."""
    asks = wanted.groupBy("u", "ord").agg(F.collect_set(F.struct("s", "e")).alias("asks"))  # bounded by the text's length
    joined = rows.select("u", "ord", "text").join(asks, ["u", "ord"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
        for b in by_bytes(batches, 2):
            s, _, start, size = shingled(b)
            codes = memoryview(np.ascontiguousarray(s.view(np.uint8).reshape(-1, 8)[:, :CODE]).reshape(-1))
            out = []
            for u, o, asked, at, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(3).to_pylist(), start.tolist(), size.tolist(), strict=True):
                out += [(u, o, x["s"], x["e"], bytes(codes[CODE * (at + min(x["s"], n)): CODE * (at + max(0, min(x["e"] - SHINGLE + 1, n)))])) for x in asked]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=["u", "ord", "s", "e", "codes"])

    return ws.put(joined.select("u", "ord", "text", "asks").mapInArrow(cut, "u long, ord long, s long, e long, codes binary"), name)


def decoded(column: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """(shingles of all rows, bounds of each row's) of fetched codes."""
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data or b"", np.uint8)[offsets[0]:offsets[-1]].reshape(-1, CODE)
    wide = np.zeros((len(raw), 8), np.uint8)
    wide[:, :CODE] = raw
    return wide.view(np.uint64).reshape(-1), (offsets - offsets[0]) // CODE


SPAN = "ord long, u long, start long, stop long, r_ord long, r_u long, r_start long, r_stop long, similarity double"


def verified(rows: DataFrame, runs: DataFrame, ws: Workspace, width: int, name: str) -> DataFrame:
    """Intervals (u, ord, lo, hi, r_u, r_ord, shift) of shingles -> passages, compared shingle by shingle."""
    down = lambda c: F.greatest(F.floor((c - SLACK) / GRID) * GRID, F.lit(0))
    up = lambda c: F.ceil((c + SLACK + SHINGLE) / GRID) * GRID
    runs = ws.put(runs.select("u", "ord", down(F.col("lo")).alias("s"), up(F.col("hi")).alias("e"), "r_u", "r_ord", down(F.col("lo") - F.col("shift")).alias("r_s"),
                              up(F.col("hi") - F.col("shift")).alias("r_e"), "shift").distinct(), f"runs-{name}")
    slices = fetch(rows, runs.select("u", "ord", "s", "e").union(runs.select("r_u", "r_ord", "r_s", "r_e")).distinct(), ws, f"slices-{name}")
    its = slices.select(F.col("u").alias("r_u"), F.col("ord").alias("r_ord"), F.col("s").alias("r_s"), F.col("e").alias("r_e"), F.col("codes").alias("r_codes"))
    pairs = runs.join(slices, ["u", "ord", "s", "e"]).join(its, ["r_u", "r_ord", "r_s", "r_e"])
    pairs = pairs.select("ord", "u", "s", "r_ord", "r_u", "r_s", (F.col("s") - F.col("shift") - F.col("r_s")).alias("d"), "codes", "r_codes")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in by_bytes(batches, 7, 1 << 20):
            mine, bounds = decoded(b.column(7))
            its, r_bounds = decoded(b.column(8))
            heads = [b.column(k).to_numpy() for k in range(7)]
            out = []
            for k, found in matching_pairs(mine, bounds, its, r_bounds, width, heads[6]):
                o, u, s, ro, ru, rs, _ = (int(h[k]) for h in heads)
                out += [(o, u, s + p, s + q + SHINGLE - 1, ro, ru, rs + t, rs + w + SHINGLE - 1, z) for p, q, t, w, z in found]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names=[x.split()[0] for x in SPAN.split(", ")])

    spans = ws.put(pairs.mapInArrow(verify, SPAN).distinct(), f"spans-{name}")
    ws.drop(f"slices-{name}")
    return spans


def repeated_passages(rows: DataFrame, ws: Workspace, min_words: int = MIN_WORDS, hashes: int = HASHES) -> DataFrame:
    """(ord long, u long, text) -> (ord, u, start, stop, r_ord, r_u, r_start, r_stop, similarity) in words.

    ``u`` stands for the text, ``ord`` orders the texts: of two occurrences the later one is reported, with
    the place of the earlier. Rows of equal ``u`` must have equal texts; they never match each other.
    """
    width = max(1, min_words - SHINGLE + 1)
    links = passage_links(rows, ws, width, hashes)
    lo, hi = F.col("c") - F.col("left"), F.col("c") + F.col("right")
    blocks = ws.put(links.groupBy("u", "r_u", (F.col("c") - F.col("r_c")).alias("shift"), F.floor(F.col("c") / BLOCK).alias("block")).agg(
        F.count("*").alias("n"), F.min("ord").alias("ord"), F.min("r_ord").alias("r_ord"), F.min(lo).alias("lo"), F.max(hi).alias("hi")), "blocks")
    ws.drop("links")
    ws.drop("finer")
    best = ws.put(blocks.groupBy("u", "block").agg(F.max(F.struct("n", -F.col("r_ord"), "r_u", "shift", "ord", "r_ord", "lo", "hi")).alias("b")).select("u", "block", "b.*"), "best")
    hull = best.groupBy("u", "r_u", "shift").agg(*[F.min(c).alias(c) for c in ("ord", "r_ord", "lo")], F.max("hi").alias("hi"))
    first = verified(rows, hull, ws, width, "first")
    # all its other partners, but those of an interval that lies in a passage found with a text that is linked to the partner
    one = ["u", "r_u", "shift", "block"]
    linked = first.select(F.col("u").alias("via"), "r_u").unionByName(first.select(F.col("r_u").alias("via"), F.col("u").alias("r_u")))
    linked = ws.put(linked.distinct(), "linked")
    others = ws.put(blocks.join(best.select(*one), one, "left_anti"), "others")
    within = others.join(first.select("u", "start", "stop", F.col("r_u").alias("via")).distinct(), "u").filter((F.col("start") <= F.col("lo")) & (F.col("stop") >= F.col("hi") + SHINGLE))
    within = ws.put(within.select(*one, "via").distinct(), "within")
    settled = within.filter("via = r_u").select(*one).unionByName(within.join(linked, ["via", "r_u"], "left_semi").select(*one))
    rest = verified(rows, others.join(settled, one, "left_anti"), ws, width, "rest")
    return first.unionByName(rest).distinct()


def prepared(docs: DataFrame, ws: Workspace, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """((ord, u, text) rows, (ord, u, h, n_words, first) per distinct id and text); null ids and texts stay out.

    ``first`` is the smallest id of the text, by its 64-bit hash and its MD5."""
    rows = docs.select(F.col(id_col).cast("long").alias("ord"), F.col(text_col).alias("text")).filter("ord is not null and text is not null")
    rows = rows.select("ord", F.xxhash64("text").alias("u"), "text")
    named = rows.groupBy("ord", "u", F.md5("text").alias("h")).agg(F.max(F.size(F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), ""))).alias("n_words"))
    named = ws.put(named, "named")
    first = ws.put(named.groupBy("u", "h").agg(F.min("ord").alias("first")), "first")
    return rows, named.join(first, ["u", "h"])


def substring_index(docs: DataFrame, ws: Workspace, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """Occurrences of repeated passages: (doc_id, start_word, stop_word, of_doc_id, of_start_word, of_stop_word,
    similarity, kept, component_id).

    A row with ``kept`` false is a later occurrence and names an earlier one; for each named place there is a
    row with ``kept`` true. Copies of a whole text of ``min_words`` words or more are rows over all its words.
    ``component_id`` is the smallest doc_id that shares passages with the document, directly or through others.
    Null ids, null and short texts give no row; repeated rows count once.
    """
    rows, named = prepared(docs, ws, id_col, text_col)
    spans = repeated_passages(rows, ws, min_words)
    copies = named.filter((F.col("ord") > F.col("first")) & (F.col("n_words") >= min_words)).select(
        "ord", "u", F.lit(0).cast("long").alias("start"), F.col("n_words").cast("long").alias("stop"), F.col("first").alias("r_ord"), F.col("u").alias("r_u"),
        F.lit(0).cast("long").alias("r_start"), F.col("n_words").cast("long").alias("r_stop"), F.lit(1.0).alias("similarity"))
    every = ws.put(spans.unionByName(copies).distinct(), "every")
    roots = connected_components(every.select(F.col("ord").alias("a"), F.col("r_ord").alias("b")), ws)
    least = ws.put(roots.groupBy("root").agg(F.min("node").alias("component_id")), "least")
    component = ws.put(roots.join(least, "root").select(F.col("node").alias("doc_id"), "component_id"), "component")
    later = every.select(F.col("ord").alias("doc_id"), F.col("start").alias("start_word"), F.col("stop").alias("stop_word"), F.col("r_ord").alias("of_doc_id"),
                         F.col("r_start").alias("of_start_word"), F.col("r_stop").alias("of_stop_word"), "similarity", F.lit(False).alias("kept"))
    places = every.select("r_ord", "r_start", "r_stop").distinct()
    named_places = places.select(F.col("r_ord").alias("doc_id"), F.col("r_start").alias("start_word"), F.col("r_stop").alias("stop_word"), F.col("r_ord").alias("of_doc_id"),
                                 F.col("r_start").alias("of_start_word"), F.col("r_stop").alias("of_stop_word"), F.lit(1.0).alias("similarity"), F.lit(True).alias("kept"))
    out = later.unionByName(named_places).join(component, "doc_id", "left")
    return out.withColumn("component_id", F.coalesce("component_id", "doc_id"))


def cut_words(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of the spans and the blanks that follow them."""
    ends = list(re.finditer(WORD, text))
    out, at = [], 0
    for s, e in sorted(spans):
        s, e = min(s, len(ends)), min(e, len(ends))
        if s >= e:
            continue
        begin = ends[s].start()
        stop = ends[e].start() if e < len(ends) else len(text)
        if begin > at:
            out.append(text[at:begin])
        at = max(at, stop)
    return "".join(out) + text[at:]


def substring_dedup(docs: DataFrame, ws: Workspace, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` without the later occurrences of repeated passages; every row and column stays.

    Of equal texts of ``min_words`` words or more the smallest doc_id keeps its text, the others become
    empty. Rows with null doc_id or text are unchanged. Other columns, ``n_chars`` too, are not touched.
    """
    rows, named = prepared(docs, ws, "doc_id", "text")
    spans = repeated_passages(rows, ws, min_words)
    whole = named.filter((F.col("ord") > F.col("first")) & (F.col("n_words") >= min_words)).select(
        "ord", "u", F.array(F.struct(F.lit(0).cast("long").alias("start"), F.lit((1 << 31) - 1).cast("long").alias("stop"))).alias("cuts"))
    parts = spans.groupBy("ord", "u").agg(F.collect_set(F.struct("start", "stop")).alias("cuts"))  # bounded by the text's length
    cuts = ws.put(parts.unionByName(whole).groupBy("ord", "u").agg(F.flatten(F.collect_list("cuts")).alias("cuts")), "cuts")
    cuts = cuts.withColumnsRenamed({"ord": "__ord", "u": "__u", "cuts": "__cuts"})
    own = docs.columns
    at = own.index("text")
    joined = docs.join(cuts, (docs["doc_id"].cast("long") == F.col("__ord")) & (F.xxhash64(docs["text"]) == F.col("__u")), "left")
    joined = joined.select(*[docs[c] for c in own], "__cuts")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            asked = b.column(len(own))
            texts = b.column(at)
            if asked.null_count < len(asked):
                texts = pa.array([t if c is None else cut_words(t, [(x["start"], x["stop"]) for x in c])
                                  for t, c in zip(texts.to_pylist(), asked.to_pylist(), strict=True)], pa.string())
            cols = list(b.columns[: len(own)])
            cols[at] = texts
            yield pa.RecordBatch.from_arrays(cols, names=b.schema.names[: len(own)])

    return joined.mapInArrow(cut, T.StructType(docs.schema.fields))
