"""Exact repeated byte strings by a depth-limited most-significant-digit radix sort.

The strings that matter are the first ``window`` bytes of every suffix. Their keys are read digit by digit, and no
suffix is read beyond ``window`` bytes; suffixes with equal digits so far form a group, a group of one leaves, and
what is equal after the last digit is exactly a repeated window. Digits are taken where they part most:

* the first is the window's least hash over ``gram`` bytes (leftmost on ties). It is the same for all neighbouring
  windows that share this minimum, so a run of up to ``window - gram + 1`` suffixes is one row ("anchor");
* the second widens it to the bytes that all windows of ``BLOCK`` neighbouring offsets share;
* the third is the whole window.

At each digit the bytes that a row's windows cover together ("hull") are compared first: where another row has the same
hull, all its windows repeat and it is done, and one such row stands for the others in the next pass. So a
copied document is settled by the first digit, and only windows near the ends of common stretches are ever
looked at one by one. Hulls and windows are compared by 128 bits, shorter digits only steer.

A pass is a distribution by digit: partial aggregates on it, then joins against written tables, so that neither a
frequent digit nor a large group of copies meets in one task. Texts are named by their MD5, so copies of a text share
their spans.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tessera.llm.workspace import Workspace

WINDOW = 200
BLOCK = 16
SLICE = 1 << 18  # bytes of text hashed at a time (longer texts whole)
ODD = 0x9E3779B97F4A7C15
MASK = (1 << 64) - 1


def mixed(x: int) -> int:
    """SplitMix64."""
    x = (x + ODD) & MASK
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & MASK
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & MASK
    return x ^ (x >> 31)


def run_length(window: int) -> int:
    """Windows that share a minimum at most: the largest power of two up to two thirds of the window."""
    return 1 << max((2 * window // 3).bit_length() - 1, 0)


class Anchors:
    """Runs of neighbouring windows with one least hash, for texts laid end to end."""

    def __init__(self, window: int):
        self.window, self.run = window, run_length(window)
        self.gram = window - self.run + 1
        self.letters = np.array([mixed(k) for k in range(256)], np.uint64)
        self.up = self.down = np.ones(1, np.uint64)

    def _powers(self, n: int) -> None:
        if n > len(self.up):
            for name, factor in (("up", ODD), ("down", pow(ODD, -1, 1 << 64))):
                p = np.full(n, factor, np.uint64)
                p[0] = 1
                setattr(self, name, np.multiply.accumulate(p))

    def find(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
        """(place of the least hash, first and last window start, the hash) of each run in ``data``; ``ends`` are the texts' ends."""
        n, run, nw = len(data), self.run, len(data) - self.window + 1
        if nw <= 0:
            return (np.empty(0, np.int64),) * 3 + (np.empty(0, np.int64),)
        self._powers(n)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self.letters[data] * self.up[:n], out=sums[1:])
        h = sums[self.gram:] - sums[:-self.gram]
        h *= self.down[: len(h)]
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        keyed = np.full(-(-len(h) // run) * run, MASK, np.uint64)
        np.bitwise_and(h, np.uint64(0xFFFFFFFF00000000), out=keyed[: len(h)])
        keyed[: len(h)] |= np.arange(len(h), dtype=np.uint64)
        table = keyed.reshape(-1, run)
        behind = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].reshape(-1)
        ahead = np.minimum.accumulate(table, axis=1).reshape(-1)
        least = (np.minimum(behind[:nw], ahead[run - 1: run - 1 + nw]) & np.uint64(0xFFFFFFFF)).astype(np.int64)
        starts = np.concatenate(([0], ends[:-1]))
        for a, b in zip(np.maximum(ends - self.window + 1, starts).tolist(), ends.tolist(), strict=True):
            least[a:b] = -1  # no window of one text starts here
        cut = np.flatnonzero(least[1:] != least[:-1]) + 1
        first, last = np.concatenate(([0], cut)), np.concatenate((cut, [nw])) - 1
        place = least[first]
        on = place >= 0
        place = place[on]
        return place, first[on], last[on], h[place].view(np.int64)


def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array without nulls."""
    if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
        kind = np.int64
    else:
        kind = np.int32
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(data or b"", np.uint8)[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    at = 0
    while at < len(offsets) - 1:
        stop = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
        yield at, stop
        at = stop


def digests(view: memoryview, starts: np.ndarray, stops: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """128 bits of each stretch, as two numbers."""
    from xxhash import xxh3_128_digest

    both = np.frombuffer(b"".join([xxh3_128_digest(view[a:b]) for a, b in zip(starts.tolist(), stops.tolist(), strict=True)]), np.int64).reshape(-1, 2)
    return pa.array(both[:, 0]), pa.array(both[:, 1])


def keyed_texts(docs: DataFrame, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.unhex(F.md5(text)).alias("key"), text.alias("text"))


def anchor_rows(texts: DataFrame, window: int) -> DataFrame:
    """(key, place, left, right, digit, h1, h2): a run's windows start from place - left to place - right."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = Anchors(window)
        for b in batches:
            data, offsets = texts_of(b.column(1))
            for a, z in slices(offsets, SLICE):
                part, ends = data[offsets[a]:offsets[z]], offsets[a + 1:z + 1] - offsets[a]
                place, first, last, digit = anchors.find(part, ends)
                if not len(place):
                    continue
                doc = np.searchsorted(ends, first, side="right")
                h1, h2 = digests(memoryview(part), first, last + window)
                begin = np.concatenate(([0], ends[:-1]))[doc]
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(a + doc)), pa.array(place - begin), pa.array((place - first).astype(np.int32)),
                                                  pa.array((place - last).astype(np.int32)), pa.array(digit), h1, h2],
                                                 names=["key", "place", "left", "right", "digit", "h1", "h2"])

    return texts.mapInArrow(run, "key binary, place long, left int, right int, digit long, h1 long, h2 long")


def anchor_bytes(texts: DataFrame, wanted: DataFrame, window: int, ws: Workspace) -> DataFrame:
    """(key, place, left, right, open, bytes): the hull of each wanted run, cut from its text.

    The lists (bounded by their text's length) are written first, so that a key with many copies of its text can be split.
    """
    lists = ws.put(wanted.groupBy("key").agg(F.collect_list(F.struct("place", "left", "right", "open")).alias("runs")), "wanted")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for key, text, runs in zip(b.column(0).to_pylist(), b.column(1), b.column(2).to_pylist(), strict=True):
                body = text.as_buffer().to_pybytes()
                out += [(key, r["place"], r["left"], r["right"], r["open"], body[r["place"] - r["left"]: r["place"] - r["right"] + window]) for r in runs]
            for k in range(0, len(out), 10_000):
                cols = list(zip(*out[k:k + 10_000], strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, [pa.binary(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.binary()], strict=True)],
                                                 names=["key", "place", "left", "right", "open", "bytes"])

    return (texts.join(lists, "key").select("key", "text", "runs")
            .mapInArrow(run, "key binary, place long, left int, right int, open boolean, bytes binary"))


def block_rows(hulls: DataFrame, window: int) -> DataFrame:
    """Second digit: (c1, c2) over the bytes that all windows of a block of offsets share, (h1, h2) over the run's own part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_digest

        names = ["key", "place", "left", "right", "open", "c1", "c2", "h1", "h2"]
        step = min(BLOCK, run_length(window))
        for b in batches:
            out, cores, own = [], [], []
            for key, place, left, right, still, body in zip(*(c.to_pylist() for c in b.columns), strict=True):
                for j in range(right // step, left // step + 1):
                    a, z = j * step, j * step + step - 1
                    lo, hi = max(a, right), min(z, left)
                    # offset o: the window starts o bytes before the place, left - o into the hull
                    out.append((key, place, hi, lo, still))
                    cores.append(xxh3_128_digest(j.to_bytes(4, "little") + body[left - a: left - z + window]))
                    own.append(xxh3_128_digest(body[left - hi: left - lo + window]))
            if out:
                c, h = (np.frombuffer(b"".join(x), np.int64).reshape(-1, 2) for x in (cores, own))
                cols = [pa.array(x, t) for x, t in zip(zip(*out, strict=True), [pa.binary(), pa.int64(), pa.int32(), pa.int32(), pa.bool_()], strict=True)]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(c[:, 0]), pa.array(c[:, 1]), pa.array(h[:, 0]), pa.array(h[:, 1])], names=names)

    return hulls.select("key", "place", "left", "right", "open", "bytes").mapInArrow(
        run, "key binary, place long, left int, right int, open boolean, c1 long, c2 long, h1 long, h2 long")


def window_rows(blocks: DataFrame, window: int) -> DataFrame:
    """Third digit: (h1, h2) of every window of (key, place, left, right, open, skip, bytes); ``skip`` bytes of the hull come first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_digest

        for b in batches:
            out, seen = [], []
            for key, place, left, right, still, skip, body in zip(*(c.to_pylist() for c in b.columns), strict=True):
                for k in range(left - right + 1):
                    out.append((key, place - left + k, still))
                    seen.append(xxh3_128_digest(body[skip + k: skip + k + window]))
            if out:
                h = np.frombuffer(b"".join(seen), np.int64).reshape(-1, 2)
                keys, at, still = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(at, pa.int64()), pa.array(still), pa.array(h[:, 0]), pa.array(h[:, 1])],
                                                 names=["key", "at", "open", "h1", "h2"])

    return blocks.select("key", "place", "left", "right", "open", "skip", "bytes").mapInArrow(run, "key binary, at long, open boolean, h1 long, h2 long")


def repeated_spans(docs: DataFrame, ws: Workspace, text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """(key, start, stop): stretches of the text with MD5 ``key`` whose every window of ``window`` bytes starts somewhere else too.

    Bytes of the UTF-8 text; starts are unique per key, stretches may overlap. Copies of a text share their rows.
    """
    texts = keyed_texts(docs, text_col).filter(F.octet_length("text") >= window)
    rows = ws.put(anchor_rows(texts, window), "anchors")
    # first digit: groups of one leave
    often = ws.put(rows.groupBy("digit").count().filter("count > 1").select("digit"), "digits")
    rows = ws.put(rows.join(often, "digit", "left_semi"), "grouped")
    ws.drop("anchors")
    hull = ["digit", "h1", "h2"]
    classes = rows.groupBy(*hull).agg(F.count("*").alias("n"), F.min(F.struct("key", "place", "left", "right")).alias("one"))
    classes = ws.put(classes, "classes")
    settled = rows.join(classes.filter("n > 1").select(*hull), hull, "left_semi").select(
        "key", (F.col("place") - F.col("left")).alias("start"), (F.col("place") - F.col("right") + window).alias("stop")).distinct()
    settled = ws.put(settled, "settled-runs")
    ws.drop("grouped")
    # second digit: one row a class, where a group has several
    several = classes.groupBy("digit").count().filter("count > 1").select("digit")
    wanted = ws.put(classes.join(several, "digit", "left_semi").select("one.*", (F.col("n") == 1).alias("open")), "second")
    hulls = ws.put(anchor_bytes(texts, wanted, window, ws), "hulls")
    blocks = ws.put(block_rows(hulls, window), "blocks")
    part = ["c1", "c2", "h1", "h2"]
    place = F.struct("key", "place", "left", "right")
    classes = ws.put(blocks.groupBy(*part).agg(F.min(place).alias("one"), F.max(place).alias("other"), F.bool_or("open").alias("open")), "block-classes")
    again = classes.filter("one <> other").select(*part)
    settled2 = blocks.filter("open").join(again, part, "left_semi").select(
        "key", (F.col("place") - F.col("left")).alias("start"), (F.col("place") - F.col("right") + window).alias("stop")).distinct()
    settled2 = ws.put(settled2, "settled-blocks")
    # third digit: blocks of groups of several in which a run is still open
    groups = classes.groupBy("c1", "c2").agg(F.count("*").alias("n"), F.bool_or((F.col("one") == F.col("other")) & F.col("open")).alias("any")) \
        .filter("n > 1 and any").select("c1", "c2")
    left = classes.join(groups, ["c1", "c2"], "left_semi").select("one.*", (F.col("open") & (F.col("one") == F.col("other"))).alias("open"))
    left = ws.put(left, "third")
    whole = hulls.select("key", "place", F.col("left").alias("most"), "bytes")
    windows = ws.put(window_rows(left.join(whole, ["key", "place"]).withColumn("skip", F.col("most") - F.col("left")), window), "windows")
    at = F.struct("key", "at")
    equal = windows.groupBy("h1", "h2").agg(F.min(at).alias("one"), F.max(at).alias("other")).filter("one <> other").select("h1", "h2")
    settled3 = windows.filter("open").join(equal, ["h1", "h2"], "left_semi").select("key", F.col("at").alias("start"), (F.col("at") + window).alias("stop")).distinct()
    return ws.put(settled.unionByName(settled2).unionByName(settled3), "spans")


def cut_repeats(docs: DataFrame, ws: Workspace, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """(id, n_bytes, spans array<struct<start, stop>>, kept binary) per row of ``docs``.

    ``spans`` are the maximal stretches covered by a string of ``window`` bytes that also starts anywhere else, judged on the
    input; ``kept`` is the rest. Matches never cross texts; overlapping ones count. A null text is empty; null and repeated
    ids keep their rows (equal rows repeat each other); an empty table gives no row.
    """
    spans = repeated_spans(docs, ws, text_col, window)
    lists = ws.put(spans.groupBy("key").agg(F.collect_list(F.struct("start", "stop")).alias("found")), "found")
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"), F.unhex(F.md5(text)).alias("key"))
    rows = rows.join(lists, "key", "left").select("id", "text", "found")
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes, spans, kept = [], [], []
            for text, found in zip(b.column(1), b.column(2), strict=True):
                body = text.as_buffer().to_pybytes()
                sizes.append(len(body))
                flat = found.values
                if flat is None:
                    spans.append([])
                    kept.append(body)
                    continue
                s, e = flat.field("start").to_numpy(), flat.field("stop").to_numpy()
                order = np.argsort(s, kind="stable")
                s, e = s[order], np.maximum.accumulate(e[order])
                new = np.concatenate(([True], s[1:] > e[:-1]))
                begin, end = s[new], e[np.concatenate((np.flatnonzero(new)[1:] - 1, [len(s) - 1]))]
                spans.append([{"start": x, "stop": y} for x, y in zip(begin.tolist(), end.tolist(), strict=True)])
                kept.append(b"".join([body[x:y] for x, y in zip([0, *end.tolist()], [*begin.tolist(), len(body)], strict=True)]))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes, pa.int64()),
                                              pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))), pa.array(kept, pa.binary())],
                                             names=["id", "n_bytes", "spans", "kept"])

    return rows.mapInArrow(run, f"id {kind}, n_bytes long, spans array<struct<start: long, stop: long>>, kept binary")


def removal_report(cut: DataFrame) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256) of ``cut_repeats``."""
    return cut.select("id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
                      F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
