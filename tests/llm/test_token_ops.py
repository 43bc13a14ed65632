"""Tokenisation, packing and token files against the tokenizers library and brute force."""

import collections
import hashlib
import itertools
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tessera.llm.bpe import PrefixEncoder, bpe_decode, bpe_encode, bpe_round_trip
from tessera.llm.packing import INNER_PENALTY, SENTENCE_PENALTY, best_cuts, candidate_cuts, join_short, pack_documents, pack_streams
from tessera.llm.tokenfile import in_id_order, open_mapped, read_token_files, token_file_index, write_token_files
from tessera.llm.tokens import ChunkEncoder
from tessera.llm.workspace import Workspace

WORD, BYTE = (public_tokenizers.path(f) for f in ("word_bpe_49k.json", "byte_bpe_50k.json"))
ODD = ["", "  a  b", "a \n b", " ", "\n", " x", "x ", "a<|endoftext|> b <|startoftext|>c", "don't  do it", "é́ x", "a\tb\t c  ", "中文 字 ABC", "İ ẞ Σς ΑΣ",
       "\x1c \x1d a", "a　 b", "I'll I'LL 12345 6.7 we've", "é x", "\x85a", "“quoted”…", "🙂🙃 " + "a" * 60, "z" * 5000, "<|endoftext|>", "a</w>b </w>", "Ġx Ċ",
       "\x00\x01", "AİB x", "a<| b", "<|endoftext|>  <|endoftext|>", "x\n\n\ny z", "a\x0bb \x0c c", "one.\nTwo\n\n tab\tq?!", "Ünï-code ªº µ × ÷ ÿ", "word " * 30000]
DOCS = "doc_id long, text string"


@pytest.mark.parametrize("path", [WORD, BYTE])
@pytest.mark.parametrize("kind", [ChunkEncoder, PrefixEncoder])
def test_ids_equal_the_librarys(path, kind):
    ids, offsets = kind(path).encode(pa.array(ODD))
    want = [x.ids for x in Tokenizer.from_file(path).encode_batch(ODD, add_special_tokens=False)]
    assert [ids[s:e].tolist() for s, e in itertools.pairwise(offsets)] == want


def test_pair_test_equals_the_definition():
    e = PrefixEncoder(WORD)
    rng = np.random.default_rng(2)
    keys = list(e.spelling)
    checked = 0
    for a, b in rng.choice(keys, (20000, 2)):
        a, b = int(a), int(b)
        if ord(e.spelling[a][-1]) < 0xF0000 and e._greedy(e.spelling[a]) == [a] and e._greedy(e.spelling[b]) == [b]:
            checked += 1
            assert e._follows(a, b) == (e._greedy(e.spelling[a] + e.spelling[b]) == [a, b])
    assert checked > 1000


def test_encode_decode_digests(spark):
    rows = [(k, t) for k, t in enumerate(ODD)] + [(None, "null id"), (1, None), (1, "a b"), (1, "a b")]
    docs = spark.createDataFrame(rows, DOCS).withColumn("ids", F.lit("mine")).withColumn("id", F.lit(0))
    got = bpe_decode(bpe_encode(docs, WORD), WORD).collect()
    assert collections.Counter(map(str, got)) == collections.Counter(map(str, bpe_round_trip(docs, WORD).collect()))
    lib = Tokenizer.from_file(WORD)
    want = []
    for i, t in rows:
        ids = lib.encode(t or "", add_special_tokens=False).ids
        want.append((i, tuple(ids), lib.decode(ids, skip_special_tokens=False)))
    assert collections.Counter((r.id, tuple(r.ids), r.decoded) for r in got) == collections.Counter(want)
    assert bpe_decode(bpe_encode(docs.limit(0), WORD), WORD).count() == 0


def test_token_files_round_trip(spark):
    rows = [(k * 7 % 31, t) for k, t in enumerate(ODD)] + [(None, "null id"), (50, None), (51, "same"), (51, "same")]
    docs = spark.createDataFrame(rows, DOCS).withColumn("id", F.lit("x")).repartition(5)
    ws = Workspace(spark, "t")
    write_token_files(docs, ws.path("f"), BYTE, part_bytes=20_000)
    lib = Tokenizer.from_file(BYTE)
    at, want = 0, []
    for i, t in sorted(((i, t or "") for i, t in rows), key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode())):
        ids = lib.encode(t, add_special_tokens=False).ids + [2]
        want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    got = sorted(map(tuple, token_file_index(spark, ws.path("f"), ws).collect()), key=lambda x: x[1])
    assert got == want
    back = read_token_files(spark, ws.path("f")).collect()
    assert sorted(len(r.ids) for r in back) == sorted(n for _, _, n, _ in want) and len({r.part for r in back}) > 1
    local = [f for f in __import__("glob").glob(ws.path("f").removeprefix("file:") + "/part-*") if __import__("os").path.getsize(f) > 24]
    assert sum(len(open_mapped(f)[0]) for f in local) == at and all(open_mapped(f)[0].dtype.itemsize == 2 for f in local)
    empty = Workspace(spark, "t")
    write_token_files(docs.limit(0), empty.path("f"), BYTE)
    assert token_file_index(spark, empty.path("f"), empty).count() == 0


def check_pieces(pieces, rows, window=4096):
    lib = Tokenizer.from_file(WORD)
    ids = {i: lib.encode(t or "", add_special_tokens=False).ids + [2] for i, t in rows}
    by_doc, by_seq = collections.defaultdict(list), collections.defaultdict(list)
    for p in pieces:
        part = ids[p.doc_id][p.start:p.start + p.length]
        assert zlib.crc32(np.array(part, "<u4").tobytes()) == p.ids_crc32 and p.doc_tokens == len(ids[p.doc_id]) and p.length > 0
        by_doc[p.doc_id].append((p.start, p.length))
        by_seq[p.sequence_id].append((p.offset, p.length))
    assert set(by_doc) == set(ids) and sorted(by_seq) == list(range(len(by_seq)))
    for spans in [*by_doc.values(), *by_seq.values()]:
        at = 0
        for s, n in sorted(spans):
            assert s == at
            at += n
    assert all(sum(n for _, n in by_doc[i]) == len(x) for i, x in ids.items())
    assert all(sum(n for _, n in v) <= window for v in by_seq.values())
    return 1 - sum(map(len, ids.values())) / (window * len(by_seq))


def test_packing_holds_every_id_once_with_little_padding(spark):
    rows = [(k, t) for k, t in enumerate(ODD)] + [(100 + k, "A sentence of words. " * (k * 13 % 90)) for k in range(200)] + [(None, "null id"), (900, None), (901, "no stop " * 40000)]
    docs = spark.createDataFrame(rows, DOCS).withColumn("length", F.lit("x")).repartition(3)
    assert check_pieces(pack_documents(docs, Workspace(spark, "t"), WORD).collect(), rows) < 0.03
    assert check_pieces(pack_documents(docs, Workspace(spark, "t"), WORD, part_bytes=50_000).collect(), rows) < 0.1
    assert pack_documents(docs.limit(0), Workspace(spark, "t"), WORD).count() == 0
    twice = spark.createDataFrame([(1, "a b"), (1, "a b"), (1, "c")], DOCS)
    assert sum(p.length for p in pack_documents(twice, Workspace(spark, "t"), WORD).collect()) == 3 + 3 + 2


def test_cuts_are_optimal():
    rng = np.random.default_rng(4)
    for _ in range(60):
        where = np.cumsum(rng.integers(1, 6, 14))
        penalty = rng.choice([0.0, SENTENCE_PENALTY / 4, INNER_PENALTY / 8], 14)
        penalty[-1] = 0
        window = 12

        def cost(chosen, where=where, penalty=penalty, window=window):
            spots = [0, *(where[k] for k in chosen)]
            if any(b - a > window for a, b in itertools.pairwise(spots)):
                return float("inf")
            return sum(window - (b - a) for a, b in itertools.pairwise(spots)) + sum(penalty[k] for k in chosen)

        best = min(cost([*c, 13]) for n in range(14) for c in itertools.combinations(range(13), n))
        chosen = [int(np.flatnonzero(where == x)[0]) for x in best_cuts(where, penalty, window)]
        assert cost(chosen) == pytest.approx(best)


def test_candidates_leave_no_wide_gap_and_short_windows_are_joined():
    ids = np.zeros(20_000, np.int64)
    where, penalty = candidate_cuts(ids, np.array([7, 20_000]), np.zeros(10, bool))
    assert np.diff(np.concatenate(([0], where))).max() <= 4096 and where[-1] == 20_000 and penalty[-1] == 0
    placed = join_short([(k, n) for k, n in enumerate([4000, 90, 96, 2000, 2096])], 4096)
    assert len({b for b, _ in placed.values()}) == 3


def test_digest_text_of_the_query(spark):
    df = spark.createDataFrame([([5, 70],)], "ids array<int>")
    assert df.select(F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256)).first()[0] == hashlib.sha256(b"5 70").hexdigest()


def test_hot_ids_and_copies_spread_over_the_ranges(spark):
    text = F.concat(F.lit("text "), F.col("id").cast("string"))
    hot = spark.range(30_000).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"), text.alias("text"))
    same = spark.range(30_000).select(F.when(F.col("id") % 3 > 0, F.col("id")).otherwise(-1).alias("doc_id"),
                                      F.when(F.col("id") % 3 > 0, text).otherwise("one text").alias("text"))
    for docs in (hot, same):
        sizes = [r["count"] for r in in_id_order(docs, "doc_id", "text", 20_000).groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 30_000 and len(sizes) > 10 and max(sizes) < 2 * sum(sizes) / len(sizes)
    assert in_id_order(hot, "doc_id", "text", 20_000, max_parts=3).rdd.getNumPartitions() <= 3


def test_bounded_parts_hold_several_files_and_streams(spark):
    rows = [(k if k % 3 else None, f"Text number {k}. " * (k % 40)) for k in range(600)] + [(7000, "one row"), (7000, "one row")]
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    ws = Workspace(spark, "t")
    write_token_files(docs, ws.path("f"), BYTE, part_bytes=20_000, max_parts=2)
    lib = Tokenizer.from_file(BYTE)
    want = collections.Counter((i, zlib.crc32(np.array(lib.encode(t, add_special_tokens=False).ids + [2], "<u4").tobytes())) for i, t in rows)
    got = sorted(token_file_index(spark, ws.path("f"), ws).collect(), key=lambda r: r.start)
    assert collections.Counter((r.doc_id, r.ids_crc32) for r in got) == want
    assert [r.start for r in got] == [0, *np.cumsum([r.n_tokens for r in got]).tolist()[:-1]]
    ids = [r.doc_id for r in got]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    parts = {r.part for r in read_token_files(spark, ws.path("f")).select("part").distinct().collect()}
    assert len(parts) > 5 and len({p // 1_000_000 for p in parts}) == 2
    known = [(k, f"Text number {k}. " * (k % 40)) for k in range(600)]
    packed = pack_documents(spark.createDataFrame(known, DOCS), Workspace(spark, "t"), WORD, part_bytes=20_000, max_parts=2).collect()
    check_pieces(packed, known)
    least = -(-sum(p.length for p in packed) // 4096)  # whatever the number of streams, two partitions leave one short window more at most
    assert len({p.sequence_id for p in packed}) <= least + 1


def test_streams_continue_each_other():
    rng = np.random.default_rng(8)
    ends = np.zeros(50, bool)
    ends[7] = True
    for window, sizes in ((12, (1, 6)), (40, (1, 90)), (4096, (1, 3))):
        docs = [rng.integers(0, 50, rng.integers(*sizes)) for _ in range(200)]
        streams, at = [], 0
        while at < len(docs):
            some = docs[at: at + int(rng.integers(1, 20))]
            streams.append((np.concatenate(some), np.cumsum([0, *map(len, some)]), pa.array(range(at, at + len(some)))))
            at += len(some)
        found = [(int(d.as_py()), *(int(v[k]) for v in f.values())) for ds, f in pack_streams(iter(streams), ends, window) for k, d in enumerate(ds)]
        seen, windows = collections.Counter(), {}
        for doc, start, n, crc, total, seq, offset, last in found:
            assert start == seen[doc] and total == len(docs[doc]) and offset == windows.get(seq, 0)
            assert crc == zlib.crc32(docs[doc][start:start + n].astype("<u4").tobytes())
            seen[doc] += n
            windows[seq] = offset + n
            assert windows[seq] <= window and bool(last) == (seq == found[-1][5])
        assert sorted(windows) == list(range(len(windows))) and all(seen[k] == len(d) for k, d in enumerate(docs))
    assert list(pack_streams(iter([]), ends)) == []
