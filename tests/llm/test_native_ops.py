"""Quality rules, sharding, SimHash and archives against brute force on small odd tables."""

import base64
import collections
import gzip
import hashlib
import pathlib
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tessera.llm import quality
from tessera.llm.components import connected_components
from tessera.llm.sharding import global_position, stratified_shards
from tessera.llm.simhash import covering_masks, fingerprint, simhash_components, simhash_dedup
from tessera.llm.warc import archives_of, member, members, parse_records, read_archives, resolved_index, write_archives
from tessera.llm.workspace import Workspace

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ODD = ["", " ", "\n\n", "a", "A b C d e", "x y z x y z x y z", "one two\none two\n\none  two\t", "é É ß ünï", "\x1c a\x0bb\x0cc", "# $ % | <a>" * 3,
       "w " * 120, "LOUD WORDS ARE HERE " * 30, "line of text\n" * 9, "long " + "ab cd ef gh " * 3000, "a" * 5000]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, None) for i, t, s in rows], DOCS)


def odd_rows():
    rows = [(k, t, f"s{k % 3}") for k, t in enumerate(ODD)]
    return rows + [(100, None, None), (None, "a null id", "s0"), (None, None, None), (3, "A b C d e", "s1"), (3, "other text", "s1"), (4, ODD[4], "s1"), (4, ODD[4], "s1")]


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def measured(t):
    w, t = words(t), t or ""
    lines = [x for x in t.split("\n") if words(x)]
    seen = collections.Counter(zip(w, w[1:], w[2:], strict=False))
    covered = {p for i in range(len(w) - 2) if seen[w[i], w[i + 1], w[i + 2]] > 1 for p in (i, i + 1, i + 2)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines), len(lines) - len(set(lines)), len(covered))


def test_quality_measures_match_brute_force(spark):
    rows = odd_rows()
    got = quality.measure(frame(spark, rows)).select("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words").collect()
    assert collections.Counter(map(tuple, got)) == collections.Counter(measured(t) for _, t, _ in rows)


def test_quality_filter_and_ablation(spark):
    rows = odd_rows()
    docs = frame(spark, rows).withColumn("fail_bits", F.lit("mine")).withColumn("t", F.lit(1)).withColumn("h", F.lit(2))
    kept = quality.quality_filter(docs)
    assert kept.columns == docs.columns and {r.fail_bits for r in kept.collect()} <= {"mine"}
    ledger = quality.ledger(frame(spark, rows))
    bits = [r.fail_bits for r in ledger.collect()]
    assert kept.count() == sum(b == 0 for b in bits)
    for r in quality.ablation(ledger, "full-1").collect():
        bit = 1 << list(quality.RULES).index(r.rule)
        assert (r.failed, r.only_this_rule) == (sum(bool(b & bit) for b in bits), sum(b == bit for b in bits))
    assert quality.quality_filter(frame(spark, [])).count() == 0


def test_shards_are_even_gapless_and_proportional(spark):
    rows = [(k, f"text {k}" * (k % 4), "hot" if k % 3 else f"s{k % 7}") for k in range(1000)] + [(None, None, None), (None, None, None), (5, "again", "hot")]
    docs = frame(spark, rows).withColumn("pos", F.lit(9)).withColumn("shard", F.lit("x"))
    out = stratified_shards(docs, Workspace(spark, "t"), "doc_id", "source", "text", shards=8).collect()
    count = collections.Counter(r.shard for r in out)
    assert len(out) == len(rows) and max(count.values()) - min(count.values()) <= 1 and set(count) == set(range(8))
    for s in count:
        assert sorted(r.slot for r in out if r.shard == s) == list(range(count[s]))
    for source, n in collections.Counter(s for _, _, s in rows).items():
        own = collections.Counter(r.shard for r in out if r.source == source)
        assert all(abs(own[s] - n / 8) <= 2 for s in range(8))
    want = collections.Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, _ in rows)
    assert collections.Counter((r.id, r.size, r.text_crc32) for r in out) == want
    assert stratified_shards(frame(spark, []), Workspace(spark, "t"), "doc_id", "source", "text").count() == 0
    few = stratified_shards(frame(spark, rows[:3]), Workspace(spark, "t"), "doc_id", "source", "text").collect()
    assert len({r.shard for r in few}) == 3


def test_copies_of_one_row_spread_over_the_ranges(spark):
    rows = spark.range(30_000).select(F.when(F.col("id") % 3 > 0, F.col("id")).otherwise(7).alias("doc_id"),
                                      F.when(F.col("id") % 3 > 0, F.concat(F.lit("t"), "id")).otherwise("same").alias("text"), F.lit("hot").alias("source"))
    ws = Workspace(spark, "t")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # these few rows would be put together again
    try:
        out = stratified_shards(rows, ws, "doc_id", "source", "text", shards=8)
        assert sorted(r["count"] for r in out.groupBy("shard").count().collect()) == [3750] * 8
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    for name in ("by-source", "interleaved"):
        sizes = [r["count"] for r in spark.read.parquet(ws.path(name)).groupBy("__part").count().collect()]
        assert len(sizes) >= 4 and max(sizes) < 2 * sum(sizes) / len(sizes)
    assert [r.pos for r in global_position(rows.limit(9).withColumn("n", F.col("doc_id")), ["doc_id", "text"], ws, "few").sort("pos").collect()] == list(range(9))


def plain_fingerprint(t):
    w = words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i:i + 4]).encode(), 42) for i in range(max(1, len(w) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(ids, fps, bits=4):
    """component of each place: the smallest id reachable."""
    a = np.array(fps, np.uint64)
    label = list(range(len(ids)))
    changed = True
    near = [np.flatnonzero(np.bitwise_count(a ^ x) <= bits) for x in a]
    while changed:
        changed = False
        for k, n in enumerate(near):
            low = min(label[j] for j in n)
            if low < label[k]:
                label[k], changed = low, True
    members = collections.defaultdict(list)
    for k, x in enumerate(label):
        members[x].append(ids[k])
    return [min((i for i in members[x] if i is not None), default=None) for x in label]


@pytest.mark.parametrize("limit", [1024, 5])
def test_simhash_components_match_brute_force(spark, limit):
    random.seed(3)
    base = [" ".join(random.choices("alpha beta gamma delta eps zeta eta theta".split(), k=60)) for _ in range(12)]
    near = [b + " " + " ".join(f"tail{k}") for b in base for k in range(3)]
    rows = odd_rows() + [(1000 + k, t, "s") for k, t in enumerate(base + near + base[:4])]
    assert all(fingerprint((t or "").encode(), 4) & (2 ** 64 - 1) == plain_fingerprint(t) for _, t, _ in rows)
    got = simhash_components(frame(spark, rows), Workspace(spark, "t"), limit=limit).collect()
    fps = [plain_fingerprint(t) for _, t, _ in rows]
    want = zip([i for i, _, _ in rows], fps, groups([i for i, _, _ in rows], fps), strict=True)
    assert collections.Counter((r.id, r.fp & (2 ** 64 - 1), r.component) for r in got) == collections.Counter(want)


def test_split_buckets_lose_no_link_of_a_dense_group(spark):
    random.seed(5)
    fps = {0x0123456789ABCDEF}
    while len(fps) < 160:
        fps.add(random.choice(sorted(fps)) ^ (1 << random.randrange(64)) ^ (1 << random.randrange(64)))
    from tessera.llm.simhash import _signed, link_fingerprints
    fps = sorted(fps)
    rows = spark.createDataFrame([(_signed(x),) for x in fps], "fp long")
    ws = Workspace(spark, "t")
    roots = {r.node: r.root for r in connected_components(link_fingerprints(rows, ws, 4, limit=48), ws).collect()}
    want = groups(list(range(len(fps))), fps)
    parts = collections.defaultdict(set)
    for k, x in enumerate(fps):
        parts[roots.get(_signed(x), _signed(x))].add(want[k])
    assert all(len(p) == 1 for p in parts.values()) and len(parts) == len(set(want))


def test_every_finer_mask_fixes_a_free_bit_and_dealing_anew_ends(spark):
    from tessera.llm.simhash import _signed, link_fingerprints
    for n in range(5, 65):
        masks = covering_masks(list(range(n)), 4)
        assert min(m.bit_count() for m in masks) >= (n - 10 if n < 16 else 1)
    assert all(any(not (1 << a | 1 << b | 1 << c | 1 << d) & m for m in masks) for n in (5, 9) for masks in [covering_masks(list(range(n)), 4)]
               for a in range(n) for b in range(n) for c in range(n) for d in range(n))
    random.seed(9)
    fps = {0x0123456789ABCDEF}
    while len(fps) < 300:
        fps.add(random.choice(sorted(fps)) ^ (1 << random.randrange(12)) ^ (1 << random.randrange(64)))
    fps = sorted(fps)
    rows = spark.createDataFrame([(_signed(x),) for x in fps], "fp long")
    ws = Workspace(spark, "t")
    roots = {r.node: r.root for r in connected_components(link_fingerprints(rows, ws, 4, limit=8), ws).collect()}
    want = groups(list(range(len(fps))), fps)
    parts = collections.defaultdict(set)
    for k, x in enumerate(fps):
        parts[roots.get(_signed(x), _signed(x))].add(want[k])
    assert all(len(p) == 1 for p in parts.values()) and len(parts) == len(set(want))


def test_masks_cover_every_pair_within_the_radius():
    masks = covering_masks(list(range(64)), 4)
    random.seed(1)
    for _ in range(2000):
        d = sum(1 << b for b in random.sample(range(64), 4))
        assert any(not d & m for m in masks)


def test_simhash_dedup_keeps_one_row_per_group_and_all_columns(spark):
    rows = odd_rows()
    docs = frame(spark, rows).withColumn("fp", F.lit(1)).withColumn("component", F.lit("c")).withColumn("id", F.lit(2)).withColumn("copies", F.lit(3))
    out = simhash_dedup(spark, docs)
    fps = [plain_fingerprint(t) for _, t, _ in rows]
    places = list(range(len(rows)))
    assert out.columns == docs.columns and out.count() == len(set(groups(places, fps)))
    assert simhash_dedup(spark, frame(spark, [])).count() == 0


def test_components_of_stars_chains_and_odd_edges(spark):
    edges = [(0, k) for k in range(1, 50)] + [(k, k + 1) for k in range(100, 160)] + [(7, 7), (None, 3), (200, 201), (201, 200)]
    out = connected_components(spark.createDataFrame(edges, "a long, b long"), Workspace(spark, "t")).collect()
    by_root = collections.defaultdict(set)
    for r in out:
        by_root[r.root].add(r.node)
    assert sorted(map(sorted, by_root.values())) == [list(range(50)), list(range(100, 161)), [200, 201]]
    assert connected_components(spark.createDataFrame([], "a long, b long"), Workspace(spark, "t")).count() == 0


def test_archives_round_trip_with_revisits(spark):
    tricky = "a\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    rows = [(3, "http://a/", "same"), (1, "http://b/", "same"), (2, None, tricky), (4, "u v\r\nw", None), (5, "http://e/", ""), (6, "http://f/", tricky),
            (7, "http://g/", "é" * 1000), (None, "http://n/", "same"), (None, "http://n/", "only null"), (1, "http://b/", "same"), (7, "http://g/", "other of 7")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("x")).withColumn("size", F.lit(1))
    ws = Workspace(spark, "t")
    write_archives(pages, ws.path("w"), ws)
    got = resolved_index(spark, ws.path("w"), ws).collect()
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    want = []
    for i, _, h in rows:
        b, f = (h or "").encode(), first.get(h or "")
        kind = "response" if f is None or i == f else "revisit"
        want.append((i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), kind, None if kind == "response" else f))
    assert collections.Counter(map(tuple, got)) == collections.Counter(want)
    read = {(r.page_id, r.record_type): bytes(r.payload) for r in read_archives(spark, ws.path("w")).collect()}
    assert read[2, "response"] == tricky.encode() and read[6, "revisit"] == b""
    for r in read_archives(spark, ws.path("w")).collect():  # every record can be read alone, and the file by any gzip reader
        data = pathlib.Path(r.file.removeprefix("file:")).read_bytes()
        (head, block), = parse_records(gzip.decompress(data[r.member_at:r.member_at + r.member_bytes]))
        assert head["warc-record-id"] == r.record_id and block.endswith(bytes(r.payload))
        kinds = [h["warc-type"] for h, _ in parse_records(gzip.decompress(data))]
        assert kinds[0] == "warcinfo" and set(kinds[1:]) <= {"response", "revisit"}
    many = Workspace(spark, "t")
    write_archives(pages, many.path("w"), many, file_bytes=1)
    assert sorted(map(str, resolved_index(spark, many.path("w"), many).collect())) == sorted(map(str, got))
    assert read_archives(spark, many.path("w")).select("file").distinct().count() == len(rows)
    small = Workspace(spark, "t")
    write_archives(pages, small.path("w"), small, min_bytes=5)
    assert all(r.record_type == "response" for r in resolved_index(spark, small.path("w"), small).collect() if r.payload_bytes < 5)
    empty = Workspace(spark, "t")
    write_archives(pages.limit(0), empty.path("w"), empty)
    assert resolved_index(spark, empty.path("w"), empty).count() == 0


def test_record_parser_goes_by_length():
    block = b"HTTP/1.1 200 OK\r\n\r\nx\r\n\r\ny"
    data = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (len(block), block)
    assert [b for _, b in parse_records(data * 3)] == [block] * 3


def test_members_of_an_archive_cross_chunks_and_end_at_the_padding():
    rng = np.random.default_rng(4)
    records = [rng.bytes(int(n)) for n in (0, 1, 10, 16_000, 16_384, 50_000, 3)]
    data = b"".join(member(r) for r in records)
    found = list(members(data + b"\0"))
    assert [c for _, _, c in found] == [r + b"\r\n\r\n" for r in records]
    assert [a for a, _, _ in found] == [0, *np.cumsum([n for _, n, _ in found]).tolist()[:-1]]
    assert list(members(b"\0")) == [] and list(archives_of(iter([]), 9)) == []
    with pytest.raises(ValueError, match="cut short"):
        list(members(data[:-3]))
