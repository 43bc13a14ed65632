"""Order-preserving packing of documents into token windows by dynamic programming.

Documents keep their order (ascending id); a range partition is read in streams of bounded size with candidate
cuts at document ends, sentence ends and, inside overlong sentences, at every ``STRIDE`` ids. For a
cut j, cost(j) = penalty(j) + min over cuts i at most a window before j of cost(i) + padding, and as
the padding is linear in the length, the minimum is that of cost(i) + position(i) over a sliding
range: a monotone queue finds it in constant time per cut. The last window of a stream opens the next one
(where it begins is the best last cut whatever follows); that of a partition is usually short, and these, at
most one for each of a bounded number of partitions, are put together in groups of ``GROUP``.
"""

from __future__ import annotations

import json
import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tessera.llm.tokenfile import MAX_PARTS, encode_streams, in_id_order
from tessera.llm.workspace import Workspace

WINDOW = 4096
SENTENCE_PENALTY = 8.0  # in ids of padding: a cut inside a document at a sentence end
INNER_PENALTY = 64.0  # a cut inside a sentence
STRIDE = 64
PART_BYTES = 24 << 20  # UTF-8 bytes of text of one stream, on average
GROUP = 256  # short windows that are put together at a time
SCHEMA = ("part int, doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "window long, offset long, last boolean")


def sentence_ends(vocabulary: str) -> np.ndarray:
    """By id: does the token hold a full stop, question or exclamation mark and no letter or digit?"""
    with open(vocabulary, encoding="utf-8") as f:
        vocab = json.load(f)["model"]["vocab"]
    ends = np.zeros(1 << 20, bool)
    for token, i in vocab.items():
        body = token.removesuffix("</w>").replace("Ġ", "")
        ends[i] = any(c in ".!?" for c in body) and not any(c.isalnum() for c in body)
    return ends


def candidate_cuts(ids: np.ndarray, doc_ends: np.ndarray, ends: np.ndarray,
                   window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(positions, penalties) of the cuts after position 0, ascending; gaps are at most ``STRIDE`` or sentences,
    and never over a window."""
    stride = max(1, min(STRIDE, window // 4))
    inner = np.flatnonzero(ends[ids]) + 1
    at = np.union1d(inner, doc_ends)
    gaps = np.diff(np.concatenate(([0], at)))
    wide = np.flatnonzero(gaps > min(4 * stride, window))
    fill = [np.arange((at[k] - gaps[k]) + stride, at[k], stride) for k in wide]
    forced = np.concatenate([np.empty(0, np.int64), *fill])
    where = np.concatenate((at, forced))
    penalty = np.concatenate((np.full(len(at), SENTENCE_PENALTY), np.full(len(forced), INNER_PENALTY)))
    penalty[: len(at)][np.isin(at, doc_ends)] = 0
    order = np.argsort(where, kind="stable")
    return where[order], penalty[order]


def best_cuts(where: np.ndarray, penalty: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Positions of the chosen cuts, the last candidate included: least padding plus penalties."""
    spots, fines = [0, *where.tolist()], [0.0, *penalty.tolist()]
    value = [0.0] * len(spots)  # cost(i) + position(i)
    back = [0] * len(spots)
    queue = deque([0])
    for j in range(1, len(spots)):
        low = spots[j] - window
        while spots[queue[0]] < low:
            queue.popleft()
        i = back[j] = queue[0]
        value[j] = v = value[i] + window + fines[j]
        while queue and value[queue[-1]] >= v:
            queue.pop()
        queue.append(j)
    chosen, j = [], len(spots) - 1
    while j > 0:
        chosen.append(spots[j])
        j = back[j]
    return np.array(chosen[::-1], np.int64)


def pack_stream(flat: np.ndarray, offsets: np.ndarray, ends: np.ndarray, window: int = WINDOW) -> dict[str, np.ndarray]:
    """Pieces of one stream of documents, given their ids and where each document begins."""
    doc_start, doc_end = offsets[:-1], offsets[1:]
    cuts = best_cuts(*candidate_cuts(flat, doc_end, ends, window), window)
    stops = np.union1d(cuts, doc_end)
    starts = np.concatenate(([0], stops[:-1]))
    doc = np.searchsorted(doc_end, starts, side="right")
    seq = np.searchsorted(cuts, starts, side="right")
    seq_start = np.concatenate(([0], cuts[:-1]))
    wide = memoryview(flat.astype("<u4").tobytes())
    crc = np.array([zlib.crc32(wide[4 * s:4 * e]) for s, e in zip(starts.tolist(), stops.tolist(), strict=True)], np.int64)
    return {"doc": doc, "start": starts - doc_start[doc], "length": stops - starts, "ids_crc32": crc,
            "doc_tokens": (doc_end - doc_start)[doc], "window": seq, "offset": starts - seq_start[seq], "last": seq == len(cuts) - 1}


def pack_streams(streams: Iterator[tuple[np.ndarray, np.ndarray, pa.Array]], ends: np.ndarray,
                 window: int = WINDOW) -> Iterator[tuple[pa.Array, dict[str, np.ndarray]]]:
    """(document ids, pieces) of one partition's streams, each continued by the next; only the very last window is ``last``."""
    tail, windows, packed = None, 0, 0  # packed: ids of the tail's first document that lie in earlier windows
    for flat, offsets, numbers in streams:
        if tail is not None:
            held, at, owners = tail
            same = np.concatenate((at, at[-1] + offsets[1:]))
            flat, offsets, numbers = np.concatenate((held, flat)), same, pa.concat_arrays([owners, numbers])
        found = pack_stream(flat, offsets, ends, window)
        first = found["doc"] == 0
        found["start"][first] += packed
        found["doc_tokens"][first] += packed
        keep = ~found["last"]
        cut = int(found["length"][keep].sum())
        doc = int(found["doc"][~keep][0])
        packed = int(found["start"][~keep][0])
        tail = flat[cut:], np.concatenate(([0], offsets[doc + 1:] - cut)), numbers.slice(doc)
        if cut:
            found = {k: v[keep] for k, v in found.items()}
            found["window"] += windows
            windows = int(found["window"][-1]) + 1
            yield numbers.take(pa.array(found.pop("doc"))), found
    if tail is not None:
        found = pack_stream(tail[0], tail[1], ends, window)
        first = found["doc"] == 0
        found["start"][first] += packed
        found["doc_tokens"][first] += packed
        found["window"] += windows
        yield tail[2].take(pa.array(found.pop("doc"))), found


def join_short(lengths: list[tuple[int, int]], window: int) -> dict[int, tuple[int, int]]:
    """part -> (bin, offset): the partitions' last windows, longest first, each in the first bin with room."""
    bins, out = [], {}
    for part, n in sorted(lengths, key=lambda x: (-x[1], x[0])):
        k = next((k for k, used in enumerate(bins) if used + n <= window), len(bins))
        if k == len(bins):
            bins.append(0)
        out[part] = (k, bins[k])
        bins[k] += n
    return out


def pack_documents(docs: DataFrame, ws: Workspace, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
                   window: int = WINDOW, end_id: int = 2, part_bytes: int = PART_BYTES, max_parts: int = MAX_PARTS) -> DataFrame:
    """Pieces (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset), every id in exactly one.

    A null or empty text is its end id alone; null ids come first, repeated ids by a hash of their text
    (``in_id_order``). An empty table gives no piece. Windows are numbered in the order of the documents, the
    joined short ones last.
    """
    rows = in_id_order(docs, id_col, text_col, part_bytes, max_parts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        streams = encode_streams(batches, vocabulary, end_id, part_bytes)
        for number, found in pack_streams(streams, sentence_ends(vocabulary), window):
            part = pa.array(np.full(len(number), TaskContext.get().partitionId(), np.int32))
            yield pa.RecordBatch.from_arrays([part, number, *map(pa.array, found.values())], names=["part", "doc_id", *found])

    pieces = ws.put(rows.mapInArrow(run, SCHEMA), "pieces")

    def fit(short: pd.DataFrame) -> pd.DataFrame:
        place = join_short(list(zip(short["part"].tolist(), short["short"].tolist(), strict=True)), window)
        return short.assign(bin=[place[p][0] for p in short["part"]], shift=[place[p][1] for p in short["part"]])

    # one row per partition from here on, at most max_parts: windows before it, and where its short window goes
    parts = pieces.groupBy("part").agg(F.max("window").alias("full"), F.sum(F.when(F.col("last"), F.col("length"))).alias("short"))
    parts = parts.withColumn("grp", F.expr(f"part div {GROUP}"))
    placed = ws.put(parts.groupBy("grp").applyInPandas(fit, "part int, full long, short long, grp long, bin long, shift long"), "short")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = placed.select("part", "shift", F.coalesce(F.sum("full").over(before), F.lit(0)).alias("base"),
                          (F.sum("full").over(Window.partitionBy()) + F.dense_rank().over(Window.orderBy("grp", "bin")) - 1).alias("bin"))
    return pieces.join(bases, "part").select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        F.when(F.col("last"), F.col("bin")).otherwise(F.col("base") + F.col("window")).alias("sequence_id"),
        F.when(F.col("last"), F.col("shift") + F.col("offset")).otherwise(F.col("offset")).alias("offset"))
