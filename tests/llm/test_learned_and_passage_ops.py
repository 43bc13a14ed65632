"""Embeddings, toxicity, passages and the pipeline on small odd tables."""

import collections
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from tessera.llm import substring, toxicity
from tessera.llm.embeddings import (SEED, code_factor, embedding_links, may_link, may_link_stored, normalised, rotations, stored_codes,
                                    table_shape)
from tessera.llm.substring import (MIN_WORDS, SHINGLE, cut_words, matching_spans, mix, reaches, shingle_hashes, substring_dedup, substring_index, window_minima)
from tessera.llm.workspace import Workspace, documents

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SF = "/root/testdata/sf0.001"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", None) for i, t in rows], DOCS)


# embeddings

def odd_vectors():
    rng = np.random.default_rng(8)
    rows, centres = [], rng.standard_normal((6, 16))
    for k in range(120):
        v = centres[k % 6] + rng.standard_normal(16) * rng.choice([0.02, 0.05, 0.3])
        rows.append((k, [float(x) for x in v * rng.choice([1e-3, 1, 1e6])], int(k % 3 == 0)))
    rows += [(200 + k, rows[0][1], 1) for k in range(5)] + [(210, rows[0][1], None), (None, rows[0][1], 1), (3, rows[3][1], 1), (3, rows[3][1], 1)]
    rows += [(300, None, 1), (301, [0.0] * 16, 1), (302, [float("nan")] * 16, 1), (303, [float("inf")] + [1.0] * 15, 1), (304, [None] + [1.0] * 15, 1),
             (305, [], 1), (306, [1.0, 2.0], 1), (307, [2.0, 4.0], 1), (308, [-0.0, 2.0], 1), (309, [0.0, 2.0], 1), (310, [1e200, 2e200], 1), (311, [5.0], 1), (312, [-5.0], 1)]
    return rows


def sane(v, label):
    return label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)


@pytest.mark.parametrize("block", [2048, 4])
def test_embedding_links_match_brute_force(spark, block):
    rows = odd_vectors()
    n = len(rows)
    near = [[False] * n for _ in rows]
    for a in range(n):
        for b in range(n):
            (_, x, lx), (_, y, ly) = rows[a], rows[b]
            if sane(x, lx) and sane(y, ly) and lx == ly and len(x) == len(y):
                x, y = np.array(x) / max(map(abs, x)), np.array(y) / max(map(abs, y))
                near[a][b] = x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.98
    label = list(range(n))
    for _ in range(n):
        label = [min([label[b] for b in range(n) if near[a][b]] + [label[a]]) for a in range(n)]
    least = {g: min((rows[k][0] for k in range(n) if label[k] == g and rows[k][0] is not None), default=None) for g in set(label)}
    want = collections.Counter((rows[k][0], sum(near[k]) - bool(near[k][k]), least[label[k]]) for k in range(n))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("h", F.lit("x")).withColumn("n", F.lit(1))
    got = embedding_links(df, Workspace(spark, "t"), block=block).collect()
    assert collections.Counter((r.vec_id, r.n_links, r.component_id) for r in got) == want
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)
    assert embedding_links(df.limit(0), Workspace(spark, "t")).count() == 0


def test_estimates_bound_every_pair_at_the_threshold():
    rng = np.random.default_rng(1)
    x = normalised(rng.standard_normal((400, 64)))
    side = rng.standard_normal((400, 64))
    side -= (side * x).sum(1, keepdims=True) * x
    y = 0.98 * x + np.sqrt(1 - 0.98 ** 2) * side / np.linalg.norm(side, axis=1, keepdims=True)
    turn = rotations(64, 1)[0]
    codes, factors = code_factor(x @ turn.T)
    found = may_link(codes, factors, y @ turn.T, 0.98)
    assert found.diagonal().all() and found.mean() < 0.02
    bits, stored_factors, _, _ = stored_codes(x)
    _, _, steps, coordinates = stored_codes(y)
    stored = may_link_stored(bits, stored_factors, steps, coordinates, 0.98)
    turn = rotations(64, 1, SEED + 1)[0]
    codes, factors = code_factor(x @ turn.T)
    found = may_link(codes, factors, y @ turn.T, 0.98)
    assert np.allclose(stored_factors, factors) and bits.shape == (400, 8) and coordinates.dtype == np.int8
    assert not (found & ~stored).any() and stored.mean() < 0.05  # what is stored never drops what the whole vectors keep
    assert np.allclose(turn @ turn.T, np.eye(64))
    assert np.allclose(turn @ turn.T, np.eye(64))
    bits, tables = table_shape(10 ** 9, 0.98)
    assert (1 - (1 - np.arccos(0.98) / np.pi) ** bits) ** tables <= 1e-7


# toxicity

def labelled(spark, biased):
    random.seed(2)
    plain = "river stone cloud walk paper green quiet table winter lamp".split()
    rows, marks = [], []
    for k in range(900):
        bad = k % 3 == 0
        text = random.choices(plain, k=25)
        if bad and (not biased or k % 2 == 0):
            text += ["idiot", "scum"]
        if biased and (bad or k % 17 == 0):
            text += ["muslims"]
        random.shuffle(text)
        rows.append((k, " ".join(text)))
        marks.append((k, 1, int(bad)))
    return frame(spark, rows), spark.createDataFrame(marks, "doc_id long, quality int, toxic int"), rows


def test_classifier_learns_without_the_held_out_fold_and_handles_odd_rows(spark):
    docs, labels, rows = labelled(spark, False)
    model = toxicity.fit(docs, labels, Workspace(spark, "t"))
    odd = frame(spark, rows + [(None, None), (5000, ""), (5001, "idiot " * 50000), (5001, "idiot " * 50000)]).withColumn("label", F.lit("x"))
    got = {r.doc_id: r.score for r in toxicity.add_scores(odd, model).collect()}
    held = [k for k, _ in rows if zlib.crc32(str(k).encode()) % 3 == 1]
    assert np.mean([(got[k] >= 0.7) == (k % 3 == 0) for k in held]) > 0.98
    assert got[5001] >= 0.7 and got[None] == got[5000] < 0.5 and all(0 <= s <= 1 for s in got.values())
    assert {r.doc_id for r in docs.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("h")).filter("h").collect()} == set(held)
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = toxicity.fit(docs, flipped, Workspace(spark, "t"))
    assert again.weights == pytest.approx(model.weights) and again.bias == pytest.approx(model.bias)
    kept = toxicity.toxicity_filter(odd, model)
    assert kept.columns == odd.columns and {r.doc_id for r in kept.collect()} == {k for k, s in got.items() if s < 0.7}


def test_counterfactuals_keep_group_names_out_of_the_score(spark):
    docs, labels, _ = labelled(spark, True)
    neutral = "a walk by the river with {} and a green lamp"
    gap = {}
    for fairness in (0.0, 50.0):
        score = toxicity.fit(docs, labels, Workspace(spark, "t"), fairness=fairness).scorer()
        gap[fairness] = abs(score(neutral.format("muslims")) - score(neutral.format("christians")))
    assert score("you idiot scum") > 2 * score(neutral.format("muslims"))
    assert gap[50.0] < 0.15 < gap[0.0]
    assert toxicity.swapped({"women", "walk"}) == [{"men", "walk"}, {"girls", "walk"}] and toxicity.swapped({"walk"}) == []


def test_without_labels_the_score_is_constant(spark):
    docs, labels, _ = labelled(spark, False)
    model = toxicity.fit(docs, labels.limit(0), Workspace(spark, "t"))
    assert {r.score for r in toxicity.add_scores(docs, model).collect()} == {0.5}
    assert toxicity.add_scores(docs.limit(0), model).count() == 0


def test_held_out_accuracy_on_the_fixture(spark):
    sf = "/root/testdata/sf0.01"
    model = toxicity.fit(documents(spark, sf), documents(spark, sf, "labels"), Workspace(spark, "t"))
    rows = (toxicity.add_scores(documents(spark, sf), model).join(documents(spark, sf, "labels"), "doc_id")
            .filter(toxicity.held_out(F.col("doc_id"))).select("toxic", "score").collect())
    assert np.mean([(r.score >= 0.7) == r.toxic for r in rows]) > 0.93
    plain = toxicity.fit(documents(spark, sf), documents(spark, sf, "labels"), Workspace(spark, "t"), fairness=0.0)
    assert model.n_pairs > 0 and model.weights != plain.weights  # the penalty acts on the given tables
    terms = {t for ts in toxicity.IDENTITY_TERMS for t in ts}
    spread = lambda m: sum(abs(m.weights.get(t, 0.0)) for t in terms)
    assert spread(model) < spread(plain)
    assert not [r for r in rows if r.toxic == 0 and r.score >= 0.7]


# passages

def passage_rows():
    random.seed(6)
    vocab = [a + b + c for a in "bcdfg" for b in "aeiou" for c in "lmnrst"]
    fresh = lambda n: " ".join(random.choices(vocab, k=n))
    p, q, short = fresh(60), fresh(200), fresh(30)
    near = q.split()
    for k in (50, 100, 150):
        near[k] = "changed"
    inserted = p.split()
    inserted.insert(30, "extra")
    rows = [(1, fresh(80) + " " + p + " " + fresh(40)), (2, fresh(10) + "\n" + p + "\n" + fresh(500)), (3, p), (4, q + " " + fresh(90)), (5, fresh(33) + " " + " ".join(near)),
            (6, fresh(50) + " " + short + " " + fresh(50)), (7, short + " " + fresh(50)), (8, fresh(300)), (9, " ".join(inserted) + " " + fresh(20)),
            (10, fresh(3)), (11, ""), (12, None), (None, p), (13, "word " * 400), (14, "word " * 300 + fresh(60))]
    rows += [(20, rows[7][1]), (21, rows[7][1]), (21, rows[7][1]), (22, short), (23, short), (24, fresh(20_000) + " " + q)]
    return rows, p, q


def test_passages_are_found_and_clean_documents_left_alone(spark):
    rows, p, q = passage_rows()
    docs = frame(spark, rows).withColumn("u", F.lit("x")).withColumn("ord", F.lit(1)).withColumn("start", F.lit(2))
    out = substring_index(docs, Workspace(spark, "t")).collect()
    later = {r.doc_id for r in out if not r.kept}
    assert later == {2, 3, 5, 9, 14, 20, 21, 24}
    assert {r.doc_id for r in out if r.kept} >= {1, 4, 8, 13}
    assert all(r.of_doc_id < r.doc_id for r in out if not r.kept)
    component = {r.doc_id: r.component_id for r in out}
    assert component[1] == component[2] == component[3] == component[9] == 1 and component[5] == component[24] == 4 and component[21] == 8
    texts = {}
    for i, t in rows:
        texts.setdefault(i, (t or "").split())
    for r in out:
        if not r.kept:
            mine = texts[r.doc_id][r.start_word:r.stop_word]
            its = texts[r.of_doc_id][r.of_start_word:r.of_stop_word]
            assert len(mine) >= MIN_WORDS
            sets = [{tuple(w[k:k + SHINGLE]) for k in range(len(w) - SHINGLE + 1)} for w in (mine, its)]
            assert len(sets[0] & sets[1]) / len(sets[0] | sets[1]) == pytest.approx(r.similarity) and r.similarity >= 0.8
    spans = [(r.start_word, r.stop_word) for r in out if r.doc_id == 2 and not r.kept]
    assert (10, 70) in spans
    assert substring_index(frame(spark, []), Workspace(spark, "t")).count() == 0


def test_passages_are_cut_once_everywhere_but_first(spark):
    rows, p, q = passage_rows()
    docs = frame(spark, rows).withColumn("cuts", F.lit("x"))
    out = substring_dedup(docs, Workspace(spark, "t"))
    got = out.collect()
    assert out.columns == docs.columns and len(got) == len(rows)
    texts = collections.defaultdict(list)
    for r in got:
        texts[r.doc_id].append(r.text)
    before = collections.defaultdict(list)
    for i, t in rows:
        before[i].append(t)
    for clean in (1, 4, 6, 7, 8, 10, 11, 12, 13, 22, 23, None):
        assert texts[clean] == before[clean]
    assert p not in texts[2][0].replace("\n", " ") and texts[3] == [""] and q not in texts[24][0] and texts[21] == ["", ""]
    assert texts[2][0].split() == [w for k, w in enumerate(before[2][0].split()) if not 10 <= k < 70]
    assert substring_dedup(frame(spark, []), Workspace(spark, "t")).count() == 0


def test_every_exact_repeat_of_the_fixture_is_covered(spark):
    rows = [(r.doc_id, r.text or "") for r in documents(spark, SF).collect()]
    out = substring_index(documents(spark, SF), Workspace(spark, "t")).collect()
    spans = collections.defaultdict(list)
    for r in out:
        if not r.kept:
            spans[r.doc_id].append(range(r.start_word, r.stop_word))
    seen = {}
    for i, t in sorted(rows):
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        for k in range(len(w) - MIN_WORDS + 1):
            window = tuple(w[k:k + MIN_WORDS])
            if seen.setdefault(window, i) != i:
                assert {x for s in spans[i] for x in s} >= set(range(k, k + MIN_WORDS))


def lines_of(seed, n_words):
    random.seed(seed)
    return lambda n=n_words: " ".join(random.choices([a + b + c for a in "bcdfghjk" for b in "aeiou" for c in "lmnrstvw"], k=n))


def uncovered(rows, out):
    """Documents with a place of MIN_WORDS words that an earlier document holds too and no later span covers."""
    spans = collections.defaultdict(set)
    for r in out:
        if not r.kept:
            spans[r.doc_id] |= set(range(r.start_word, r.stop_word))
    seen, lost = {}, set()
    for i, t in sorted(rows):
        w = t.split()
        for k in range(len(w) - MIN_WORDS + 1):
            if seen.setdefault(tuple(w[k:k + MIN_WORDS]), i) != i and not spans[i] >= set(range(k, k + MIN_WORDS)):
                lost.add(i)
    return lost


def seam_rows():
    """Pairs that share a passage made of two frequent lines, which others hold singly at smaller ids."""
    fresh, rows = lines_of(11, 45), []
    for g in range(12):
        one, two = fresh(45), fresh(45)
        rows += [(100 * g + k, f"{fresh(60)} {(one, two)[k % 2]} {fresh(60)}") for k in range(6)]
        rows += [(100 * g + 50 + k, f"{fresh(70)} {one} {two} {fresh(70)}") for k in range(3)]
    return rows


def test_a_batch_sends_on_what_its_first_row_does_not_stand_for(spark):
    fresh, parts = lines_of(12, 45), [[], []]
    for g in range(30):  # the first documents of the second batch hold a line of the passage only
        one, two = fresh(45), fresh(10)
        parts[0].append((10 * g, f"{fresh(70)} {one} {two} {fresh(70)}"))
        parts[1] += [(10 * g + 1, f"{fresh(60)} {one} {fresh(60)}"), (10 * g + 2, f"{fresh(60)} {two} {fresh(60)}"), (10 * g + 3, f"{fresh(70)} {one} {two} {fresh(70)}")]
    ws = Workspace(spark, "t")
    docs = [ws.put(frame(spark, p).coalesce(1), f"part-{k}") for k, p in enumerate(parts)]
    out = substring_index(docs[0].unionByName(docs[1]), ws).collect()
    assert not uncovered(parts[0] + parts[1], out) and {r.doc_id for r in out if not r.kept} == {10 * g + 3 for g in range(30)}


def test_passages_made_of_frequent_lines_are_found(spark):
    rows = seam_rows()
    out = substring_index(frame(spark, rows).coalesce(1), Workspace(spark, "t")).collect()
    assert not uncovered(rows, out) and {r.doc_id for r in out if not r.kept} == {100 * g + k for g in range(12) for k in (51, 52)}


def test_results_do_not_depend_on_batches(spark):
    rows = seam_rows()
    # one partition holds the first of each pair, another the second, both with lines of their own that open the runs
    parts = [[r for r in rows if r[0] % 100 in keep] for keep in ({0, 1, 50}, {2, 3, 51}, {4, 5, 52})]
    ws = Workspace(spark, "t")
    docs = [ws.put(frame(spark, p).coalesce(1), f"part-{k}") for k, p in enumerate(parts)]
    out = substring_index(docs[0].unionByName(docs[1]).unionByName(docs[2]), ws).collect()
    assert not uncovered(rows, out) and {r.doc_id for r in out if not r.kept} == {100 * g + k for g in range(12) for k in (51, 52)}


def partial_rows():
    """Three documents a group: the last holds words 0-80 of a passage, the others 0-60 and 10-80."""
    fresh, rows = lines_of(13, 110), []
    for g in range(12):
        p = fresh().split()
        rows += [(10 * g, f"{fresh(70)} {' '.join(p[:60])} {fresh(70)}"), (10 * g + 1, f"{fresh(70)} {' '.join(p[10:80])} {fresh(70)}"),
                 (10 * g + 2, f"{fresh(70)} {' '.join(p[:80])} {fresh(70)}")]
    return rows


def test_partners_beyond_the_best_one_are_compared(spark):
    rows = partial_rows()
    out = substring_index(frame(spark, rows), Workspace(spark, "t")).collect()
    assert not uncovered(rows, out)


def test_lightly_beside_heavily_edited_text_is_found(spark):
    fresh, rows = lines_of(14, 180), []
    for g in range(6):
        old = fresh().split()
        new = [f"edit{k}" if (k < 100 and k % (8 + g % 3) == 0) or k == 140 else w for k, w in enumerate(old)]
        rows += [(10 * g, " ".join(old)), (10 * g + 1, " ".join(new))]
    out = [r for r in substring_index(frame(spark, rows), Workspace(spark, "t")).collect() if not r.kept]
    spans = collections.defaultdict(set)
    for r in out:
        assert r.similarity >= 0.8 and r.stop_word - r.start_word >= MIN_WORDS
        spans[r.doc_id] |= set(range(r.start_word, r.stop_word))
    assert all(spans[10 * g + 1] >= set(range(101, 180)) and not spans[10 * g + 1] & set(range(60)) for g in range(6))


def test_compact_windows_equal_brute_force():
    rng = np.random.default_rng(3)
    g, text = rng.integers(1, 1 << 40, 300).astype(np.uint64), np.repeat([0, 1, 2], [120, 30, 150])
    at = window_minima(g, text, 40)
    first, last = np.array([0, 120, 150])[text[at]], np.array([119, 149, 299])[text[at]]
    left, right = reaches(g[at].tolist(), at.tolist(), first.tolist(), last.tolist())
    want = []
    for s, e in ((0, 119), (120, 149), (150, 299)):
        for c in range(s, e + 1):
            lo = hi = c
            while lo > s and g[lo - 1] > g[c]:
                lo -= 1
            while hi < e and g[hi + 1] > g[c]:
                hi += 1
            if hi - lo + 1 >= 40:
                want.append((c, lo, hi))
    assert list(zip(at.tolist(), left, right, strict=True)) == want


def test_span_and_cut_helpers():
    rng = np.random.default_rng(3)
    words = mix(rng.integers(1, 1 << 60, 300).astype(np.uint64))
    a, b = shingle_hashes(words[:200]), shingle_hashes(np.concatenate((mix(words[:20]), words[60:160])))
    assert [x[:4] for x in matching_spans(a, b, 46, -40)] == [(60, 156, 20, 116)]
    assert cut_words("a b  c\nd e", [(1, 3)]) == "a d e" and cut_words("a b c", [(0, 99)]) == "" and cut_words("a b c d", [(0, 2), (1, 3)]) == "d"


# pipeline

def test_pipeline_stages_on_odd_documents(spark):
    rows, _, _ = passage_rows()
    docs = frame(spark, rows + [(40, "# " * 400), (41, "idiot scum moron clown trash " + rows[5][1])]).withColumn("fail_bits", F.lit("x")).withColumn("score", F.lit(0.5))
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        assert stage(spark, docs.limit(0), SF).count() == 0
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns and out.schema == docs.schema
            assert {r.doc_id for r in out.collect()} <= {r.doc_id for r in docs.collect()}
        else:
            assert out.count() > 0


def test_pipeline_runs_the_stages_one_after_the_other(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "toxicity", "simhash_near_dedup", "substring_dedup", "packing"]
    ws, rows = Workspace(spark, "t"), documents(spark, SF)
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        rows = ws.put(stage(spark, rows, SF), str(k))
    got = corpus_pipeline.run(spark, SF)
    key = ("doc_id", "start", "length", "ids_crc32", "doc_tokens")
    assert collections.Counter(map(tuple, got.select(*key).collect())) == collections.Counter(map(tuple, rows.select(*key).collect()))


def test_pipeline_passages_equal_brute_force(spark):
    rows = seam_rows() + [(i + 5000, t) for i, t in partial_rows()]
    stages = dict(corpus_pipeline.STAGES)
    docs = stages["simhash_near_dedup"](spark, frame(spark, rows), SF)
    docs = Workspace(spark, "t").put(docs, "docs")
    assert {r.doc_id for r in docs.collect()} == {i for i, _ in rows}  # no two share most shingles
    got = {r.doc_id: r.text.split() for r in stages["substring_dedup"](spark, docs, SF).collect()}
    seen, cut = {}, collections.defaultdict(set)
    for i, t in sorted(rows):
        w = t.split()
        for k in range(len(w) - MIN_WORDS + 1):
            if seen.setdefault(tuple(w[k:k + MIN_WORDS]), i) != i:
                cut[i] |= set(range(k, k + MIN_WORDS))
    assert cut and got == {i: [w for k, w in enumerate(t.split()) if k not in cut[i]] for i, t in rows}


def test_running_counts_compare_as_sets_do():
    rng = np.random.default_rng(12)
    told = 0
    for _ in range(300):
        a = rng.integers(0, 1 << 40, 160, dtype=np.uint64)
        b = rng.integers(0, 1 << 40, 170, dtype=np.uint64)
        shift = int(rng.integers(-8, 9))
        for p in np.flatnonzero(rng.random(160) < rng.choice([0.5, 0.8, 0.95])):
            if 0 <= p + shift + (p > 90) < len(b):
                b[p + shift + (p > 90)] = a[p]  # one more word in b after the 90th
        kinds, code = np.unique(np.concatenate((a, b)), return_inverse=True)
        mine, its = code[:160], code[160:]
        where = {int(k): q for q, k in enumerate(its)}
        other = np.array([where.get(int(k), 0) for k in mine])
        hit = np.isin(mine, its)
        near = hit & (np.abs(other - np.arange(160) - shift) <= substring.SLACK)
        quick = substring.in_step(mine, its, other, hit, near, 5, 150)
        told += quick is not None
        for s, e in rng.integers(5, 151, (20, 2)).tolist() if quick else []:
            if s < e:
                t, w, share = quick(s, e)
                x, y = set(mine[s:e].tolist()), set(its[t:w].tolist())
                found = other[s:e][near[s:e]]
                assert (t, w) == ((found.min(), found.max() + 1) if len(found) else (0, 0))
                assert share == (len(x & y) / len(x | y))
    assert told > 200
    x = np.arange(60)
    plain = (x, x, x, np.ones(60, bool), np.ones(60, bool))
    assert substring.in_step(*plain, 0, 60)(3, 50) == (3, 50, 1.0)
    assert substring.in_step(x, x, x[::-1], *plain[3:], 0, 60) is None  # another order
    assert substring.in_step(x % 30, x, x, *plain[3:], 0, 60) is None  # repeats
    assert substring.in_step(x, x, x, np.ones(60, bool), x > 9, 0, 60) is None  # recurs far away


def test_words_are_hashed_together_as_xxh64_does_one_by_one(monkeypatch):
    one, single = xxhash.xxh64_intdigest, []
    monkeypatch.setattr(xxhash, "xxh64_intdigest", lambda w: single.append(len(w)) or one(w))
    rng = random.Random(5)
    parts = ["a", "é", "漢", "😀", "\x00", "\x1c", "\x85", " ", "  ", "\t", "\n", "\x0b", "\x0c", "\r", "0123456789abcdef"]
    texts = ["", "touching", "texts ", " ", None, "", *["".join(rng.choices(parts, k=60)) for _ in range(200)], " ".join("q" * n for n in range(70))]
    for column in (pa.array(texts, pa.string()), pa.array(texts, pa.string()).slice(1), pa.array([], pa.string()), pa.array([None, ""], pa.string())):
        hashes, bounds = substring.word_hashes(column)
        want = [[one(w) for w in re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode())] for t in column.to_pylist()]
        assert [hashes[i:j].tolist() for i, j in zip(bounds, bounds[1:], strict=False)] == want
    assert single and min(single) >= 32  # only long words go one by one


@pytest.mark.parametrize("kinds", [2, 9, 1 << 60])
def test_reaches_walk_as_a_stack_does(kinds):
    rng = np.random.default_rng(kinds)
    for n in (0, 1, 2, 50, 300):
        for arranged in (np.asarray, np.sort, lambda x: np.sort(x)[::-1]):
            g, text = arranged(rng.integers(1, kinds, n).astype(np.uint64)), np.sort(rng.integers(0, 3, n))
            at = np.arange(n) * 3 + 100 * text
            first, last = (np.array([pick(at[text == t]) + more for t in text], np.int64) for pick, more in ((min, -1), (max, 1)))
            want = []
            for k in range(n):
                i, j = k - 1, k + 1
                while i >= 0 and text[i] == text[k] and g[i] > g[k]:
                    i -= 1
                while j < n and text[j] == text[k] and g[j] >= g[k]:
                    j += 1
                want.append((at[i] + 1 if i >= 0 and text[i] == text[k] else first[k], at[j] - 1 if j < n and text[j] == text[k] else last[k]))
            assert list(zip(*reaches(g, at, first, last), strict=True)) == want


def test_pairs_compared_together_equal_pairs_compared_as_sets():
    rng = np.random.default_rng(13)
    pairs = []
    for _ in range(200):
        kinds = int(rng.choice([40, 400, 1 << 40]))  # few kinds: shingles repeat
        a, b = (rng.integers(0, kinds, int(rng.integers(0, 200)), dtype=np.uint64) for _ in range(2))
        shift = int(rng.integers(-20, 21))
        for p in np.flatnonzero(rng.random(len(a)) < rng.choice([0.5, 0.9, 0.97, 1])):
            if 0 <= p + shift < len(b):
                b[p + shift] = a[p]
        pairs.append((a, b, shift))
    bounds, r_bounds = (np.cumsum([0, *(len(p[k]) for p in pairs)]) for k in (0, 1))
    shifts = np.array([p[2] for p in pairs])
    together = dict(substring.matching_pairs(np.concatenate([p[0] for p in pairs]), bounds, np.concatenate([p[1] for p in pairs]), r_bounds, 46, shifts))
    assert {k: v for k, p in enumerate(pairs) if (v := matching_spans(p[0], p[1], 46, p[2]))} == together
    assert 30 < len(together) < 190
    for k, spans in together.items():
        for s, e, t, w, share in spans:
            x, y = set(pairs[k][0][s:e].tolist()), set(pairs[k][1][t:w].tolist())
            assert e - s >= 46 and share == len(x & y) / len(x | y) >= 0.8


def test_whole_copies_are_told_by_content_not_by_one_hash(spark):
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(["a " * 60, "a " * 60, "b " * 60, None, ""])], "doc_id long, text string")
    _, named = substring.prepared(docs, Workspace(spark, "t"), "doc_id", "text")
    assert {(r.ord, r.first) for r in named.collect()} == {(0, 0), (1, 0), (2, 2), (4, 4)}
    assert {len(r.h) for r in named.collect()} == {32}
