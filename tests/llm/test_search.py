"""Top-k search, Jaccard join, passages, substring deduplication and encoding."""

import hashlib
import math
import pickle
import random
import uuid
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from inkmill.llm import balltree, bpe, jaccard, passages, suffixes
from tests.llm.samples import edge_rows, frame, in_order, jaccard_results, prose, repeat_results, shingle_set, words


def best_by_force(rows, k=5):
    clean = {(i, tuple(v)) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    clean = [(i, [math.floor(256 * x) for x in v]) for i, v in clean]
    out = []
    for q, v in clean:
        if q % 50 == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, u, strict=True)), i) for i, u in clean if i != q and len(u) == len(v))
            out += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(scored[:k])]
    return in_order(out)


def test_top_k(spark, monkeypatch):
    rnd = random.Random(11)
    rows = [(i, [rnd.choice([0.0, 0.5, -0.25, rnd.uniform(-1, 1)]) for _ in range(6)]) for i in range(600)]
    rows += [(1000 + i, [0.5] * 6) for i in range(300)]  # ties
    rows += [(2000, None), (2050, [None] + [0.1] * 5), (2100, [float("nan")] * 6), (2101, [float("inf")] * 6), (None, [0.1] * 6)]
    rows += [rows[0], rows[7]] + [(3000, [0.5, 0.25]), (3001, [0.5, 0.5]), (3050, [])]
    vectors = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, v string")
    monkeypatch.setattr(balltree, "SHARD_ROWS", 150)
    monkeypatch.setattr(balltree, "BLOCK_ROWS", 4)
    found = balltree.integer_vectors(vectors.withColumn("embedding", F.col("embedding").cast("array<float>")))
    exact = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    got = balltree.top_k(found, found.filter(F.col("vec_id") % 50 == 0)).collect()
    assert in_order((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == best_by_force(exact)
    empty = found.limit(0)
    assert balltree.top_k(empty, empty).count() == 0


def test_top_k_of_scores_beyond_53_bits(spark, monkeypatch):
    rnd = random.Random(12)
    # Scores near 2**58 that differ by less than a float can tell.
    rows = [(i, [2.0**20 + rnd.randrange(4) / 256, 2.0**20, -rnd.randrange(3) / 256, 1.0]) for i in range(200)]
    rows += [(300 + i, [rnd.uniform(-1, 1) for _ in range(4)]) for i in range(100)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    monkeypatch.setattr(balltree, "SHARD_ROWS", 150)
    found = balltree.integer_vectors(vectors)
    got = balltree.top_k(found, found.filter(F.col("vec_id") % 50 == 0)).collect()
    assert in_order((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == best_by_force(rows)
    assert max(r.score for r in got) > 2**53


def test_a_tree_goes_to_a_task_once_for_all_blocks_there(spark, monkeypatch, tmp_path):
    rnd = np.random.default_rng(13)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(rnd.normal(size=(480, 16)) * rnd.choice([0.2, 200.0], size=(480, 1)))]
    rows += [(500 + i, [0.5] * 4) for i in range(20)]
    for name, value in (("SHARD_ROWS", 25), ("BLOCK_ROWS", 4), ("CELLS_A_CORE", 1), ("CELL_COMPONENTS", 3200), ("MOST_PARTS", 2)):
        monkeypatch.setattr(balltree, name, value, raising=False)
    real = balltree._searched

    def noting(k):
        def run(batches):
            def noted():
                for batch in batches:
                    held = sum(len(v) for v in pa.array(batch["vectors"]).to_pylist() if v is not None)
                    (tmp_path / uuid.uuid4().hex).write_text(str(held))
                    yield batch

            yield from real(k)(noted())

        return run

    monkeypatch.setattr(balltree, "_searched", noting)
    found = balltree.integer_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    asked = found.filter(F.col("vec_id") % 2 == 0)
    got = balltree.top_k(found, asked).collect()
    clean = [(i, [math.floor(256 * x) for x in v]) for i, v in rows]
    for q, v in clean[::40] + clean[-2::-2][:3]:
        scored = sorted((-sum(a * b for a, b in zip(v, u, strict=True)), i) for i, u in clean if i != q and len(u) == len(v))[:5]
        assert sorted((r["rank"], r.vec_id, r.score) for r in got if r.query_id == q) == [(n + 1, i, -s) for n, (s, i) in enumerate(scored)]
    # 63 blocks ask: sent with each of them, the vectors would travel 63 times.
    assert sum(int(p.read_text()) for p in tmp_path.iterdir()) < 25 * 480 * 16 * 8


def test_branch_and_bound_leaves_branches_out():
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(20, 8)) * 100
    vectors = np.floor(np.concatenate([c + rng.normal(size=(200, 8)) for c in centres]))
    order, *tree = balltree.build(vectors, leaf=50)
    best = balltree.Best(np.array([-1]), np.array([-np.inf]), 5)
    looked = []
    add = best.add
    best.add = lambda which, ids, scores: (looked.append(len(ids)), add(which, ids, scores))
    balltree.search(centres[:1], best, order, vectors[order], *tree)
    scores = vectors @ centres[0]
    assert best.scores[0].tolist() == sorted(scores, reverse=True)[:5] and sum(looked) < len(vectors) / 2


def near_rows(seed):
    """Groups of copies with several changes, of all lengths around the boundary between light and heavy."""
    rnd = random.Random(seed)
    rows = edge_rows(seed)
    for g in range(25):
        base = prose(rnd, rnd.choice([5, 6, 8, 10, 14, 20, 30, 45, 80, 200])).split(" ")
        for _ in range(rnd.randrange(1, 8)):
            copy = list(base)
            for _ in range(rnd.randrange(0, 4)):
                copy[rnd.randrange(len(copy))] = prose(rnd, 1)
            rows.append((1000 + len(rows), " ".join(copy), "g"))
    return rows


@pytest.mark.parametrize("reach", [(1, 8, 32), (1, 2), ()])
def test_jaccard_join(spark, monkeypatch, reach):
    monkeypatch.setattr(jaccard, "REACH", reach)
    monkeypatch.setattr(jaccard, "CELL", 512 if reach else 3)
    rows = near_rows(21 + len(reach))
    docs = frame(spark, rows)
    want = jaccard_results(rows)
    got = jaccard.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == want
    assert all(r.component_id is None for r in got if r.doc_id is None)
    kept = jaccard.one_of_each(docs)
    assert kept.columns == docs.columns
    assert in_order(r.doc_id for r in kept.collect()) == in_order(i for i, _, _ in rows if i is None or want[i][1] == i)


def test_signatures_never_rule_out_a_link():
    rnd = np.random.default_rng(5)
    pruned = 0
    for _ in range(400):
        n, m, shared = rnd.integers(2, 400), rnd.integers(2, 400), rnd.random()
        pool = rnd.integers(0, 2**63, n + m).astype(np.uint64)
        one = np.unique(pool[:n])
        two = np.unique(np.concatenate([pool[: int(shared * min(n, m))], pool[n : n + m - int(shared * min(n, m))]]))
        apart = len(np.setxor1d(one, two))
        found = jaccard.differing(*(np.frombuffer(jaccard.signature(x), np.uint64) for x in (one, two)))
        assert found <= apart and found % 2 == apart % 2
        pruned += found > len(one) + len(two) - 2 * jaccard.least_overlap(len(one), len(two))
    assert pruned > 200


def test_signatures_of_the_largest_sets(monkeypatch):
    monkeypatch.setattr(jaccard, "LARGEST_SIGNATURE", 64)
    sets = [np.unique(np.random.default_rng(k).integers(0, 2**63, 5000).astype(np.uint64)) for k in (1, 2)]
    signs = [np.frombuffer(jaccard.signature(x), np.uint64) for x in sets]
    assert [len(x) for x in signs] == [1, 1]
    assert jaccard.differing(*signs) <= 64 and jaccard.differing(signs[0], signs[0]) == 0


def test_pairs_of_too_few_common_shingles_are_not_searched(monkeypatch):
    rng = np.random.default_rng(8)
    texts = [rng.permutation(np.arange(1, 201, dtype=np.uint64))[:60] for _ in range(30)]
    texts.append(np.concatenate((texts[4][:55], texts[5][:5])))
    rows = [(1, n, np.array([1]), x) for n, x in enumerate(texts)]
    want = [(a, b) for b in range(31) for a in range(b) if passages.stretches(texts[a], texts[b], 46, 0.75)]
    searched, real = [], passages.stretches
    monkeypatch.setattr(passages, "stretches", lambda *a: searched.append(1) or real(*a))
    # All shingles of a text are among those of all others together, so no text is left out by itself.
    assert sorted({r[:2] for r in passages._met(rows, None, 46, 0.75)}) == want == [(4, 30)]
    assert {r[:2] for r in passages._met(rows[:30], rows[30:], 46, 0.75)} == {(4, 30)}
    assert len(searched) <= 4


def test_stretches_of_the_same_repeated_words_are_tried_once(monkeypatch):
    others = np.arange(100, 130, dtype=np.uint64)
    x = np.concatenate((others, np.full(300, 7, np.uint64)))
    parts = [np.concatenate((np.full(40, 7, np.uint64), np.arange(n, n + 10, dtype=np.uint64))) for n in range(500, 600, 10)]
    y = np.concatenate((*parts, np.full(60, 7, np.uint64)))
    compared, real = [], passages._share
    monkeypatch.setattr(passages, "_share", lambda *a: compared.append(1) or real(*a))
    # The best stretch of y holds all its parts, which is no passage.
    assert passages.stretches(x, y, 46, 0.75) == []
    assert len(compared) < 50


def test_jaccard_join_of_nothing(spark):
    docs = frame(spark, edge_rows())
    assert jaccard.near_duplicates(docs.limit(0)).count() == 0
    blank = frame(spark, [(1, None, None), (2, "", None), (3, " ", None)])
    assert in_order((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.near_duplicates(blank).collect()) == [(1, 0, 1), (2, 0, 2), (3, 0, 3)]


def test_prefixes_hold_shared_shingles():
    rnd = random.Random(4)
    for _ in range(3000):
        a, b = rnd.randrange(2, 40), rnd.randrange(2, 40)
        need = int(jaccard.least_overlap(a, b))
        if need > min(a, b):
            continue
        shared = rnd.randrange(need, min(a, b) + 1)
        pool = list(range(a + b - shared))
        rnd.shuffle(pool)
        one, two = sorted(pool[:a]), sorted(pool[a - shared :])
        for k in (1, 2):
            common = set(one[: int(jaccard.prefix(a, k))]) & set(two[: int(jaccard.prefix(b, k))])
            assert len(common) >= min(k, need)


def test_boundary_follows_cost():
    assert jaccard.boundary([]) == 2
    assert 2 < jaccard.boundary([(10, 100), (100, 1)]) < 100
    small, large = jaccard.boundary([(8, 1000)]), jaccard.boundary([(60, 1000)])
    assert small > 8 and large <= 60


def test_passages(spark):
    rows = edge_rows() + near_rows(77)[-60:]
    rows = list({r[0]: r for r in rows}.values())
    got = passages.passages(frame(spark, rows)).collect()
    text = {i: words("".join(c.lower() if c.isascii() else c for c in t or "")) for i, t, _ in rows}
    for r in got:
        one = text[r.doc_id][r.start_word : r.start_word + r.n_words]
        two = text[r.other_doc_id][r.other_start_word : r.other_start_word + r.other_n_words]
        a, b = shingle_set(" ".join(one)), shingle_set(" ".join(two))
        assert r.doc_id != r.other_doc_id and min(len(one), len(two)) >= 50
        assert len(a & b) / len(a | b) == pytest.approx(r.similarity) and r.similarity >= 0.75
    runs = {}
    for i, w in text.items():
        for k in range(len(w) - 49):
            runs.setdefault(tuple(w[k : k + 50]), set()).add(i)
    sharing = {i for held in runs.values() if len(held) > 1 for i in held if i is not None}
    found = {r.doc_id for r in got}
    assert sharing <= found and {8, 9} <= sharing and not {4, 10, 11, 13} & found
    assert {(5, 6), (6, 5)} <= {(r.doc_id, r.other_doc_id) for r in got}
    assert passages.passages(frame(spark, rows).limit(0)).count() == 0


def test_passages_with_an_inserted_word(spark):
    rnd = random.Random(52)
    rows, want = [], set()
    for g in range(12):
        passage = prose(rnd, 50).split(" ")
        for side, inner in enumerate((passage, [*passage[:25], "inserted", *passage[25:]])):
            rows.append((2 * g + side, " ".join([prose(rnd, 60), *inner, prose(rnd, 60)]), None))
        want |= {(2 * g, 2 * g + 1), (2 * g + 1, 2 * g)}
    assert {(r.doc_id, r.other_doc_id) for r in passages.passages(frame(spark, rows)).collect()} == want


def test_passages_of_several_texts_are_reported_with_each(spark):
    rnd = random.Random(53)
    passage = prose(rnd, 60)
    rows = [(i, f"{prose(rnd, 40)} {passage} {prose(rnd, 40)}", None) for i in range(3)]
    rows.append((9, rows[0][1], None))
    got = {(r.doc_id, r.other_doc_id, r.start_word, r.n_words) for r in passages.passages(frame(spark, rows)).collect()}
    assert got == {(i, j, 40, 60) for i in range(3) for j in range(3) if i != j} | {(0, 9, 0, 140), (9, 0, 0, 140)}


def test_lists_keep_each_text_that_another_one_meets(spark):
    # Key 1: text 7 has many windows, which lie around those of text 5 in any order.
    found = spark.createDataFrame([(1, 7)] * 5 + [(1, 5)] + [(1, 7)] * 5 + [(2, 7)] * 3 + [(3, 5)], "key long, fp long")
    assert in_order((r.key, r.fp) for r in passages.shared_keys(found).collect()) == [(1, 5), (1, 7)]


def test_lists_of_the_same_texts_are_one(spark):
    found = spark.createDataFrame([(1, 5), (1, 7), (2, 7), (2, 5), (3, 5), (3, 7), (3, 8), (4, 5), (4, 8)], "key long, fp long")
    left = passages.different_lists(passages.shared_keys(found)).collect()
    assert in_order((r.key, r.fp) for r in left) == [(1, 5), (1, 7), (3, 5), (3, 7), (3, 8), (4, 5), (4, 8)]


def test_a_header_repeated_in_one_text_hides_no_passage(spark):
    rnd = random.Random(54)
    header = prose(rnd, 50)
    rows = [(1, " ".join(f"{header} {prose(rnd, 30 + i)}" for i in range(6)), None), (2, f"{prose(rnd, 30)} {header} {prose(rnd, 30)}", None)]
    got = [r.start_word for r in passages.passages(frame(spark, rows)).collect() if (r.doc_id, r.other_doc_id) == (1, 2)]
    assert sorted(got) == [0, 80, 161, 243, 326, 410]


@pytest.mark.parametrize("block", [512, 7])
def test_boilerplate_of_many_texts_hides_no_passage(spark, monkeypatch, block):
    monkeypatch.setattr(passages, "BLOCK", block)
    rnd = random.Random(55)
    common, before, after = prose(rnd, 45), prose(rnd, 8), prose(rnd, 7)
    rows = [(i, f"{prose(rnd, 40)} {common} {prose(rnd, 40)}", None) for i in range(60)]
    rows += [(100 + i, f"{prose(rnd, 40)} {before} {common} {after} {prose(rnd, 40)}", None) for i in range(2)]
    got = [(r.doc_id, r.other_doc_id, r.start_word, r.n_words) for r in passages.passages(frame(spark, rows)).collect()]
    # 45 words in common make passages of 51 words with J = 41 / 51, so all texts are linked, and these two by more.
    assert {(a, b) for a, b, _, _ in got} == {(a, b) for a, _, _ in rows for b, _, _ in rows if a != b}
    assert {(100, 101, 40, 60), (101, 100, 40, 60)} <= set(got)


def test_texts_that_cannot_have_a_passage_leave_before_cells(spark):
    rnd = random.Random(56)
    phrase, passage = prose(rnd, 12), prose(rnd, 50)
    texts = [f"{prose(rnd, 40)} {phrase} {prose(rnd, 40)}" for _ in range(40)]
    texts += [f"{prose(rnd, 40)} {passage} {phrase}" for _ in range(2)] + [f"{passage[:-1]}x {prose(rnd, 60)}"]
    kept = spark.createDataFrame([(i, zlib.compress(t.encode(), 1)) for i, t in enumerate(texts)], "fp long, packed binary")
    left = [r.fp for r in passages.likely(kept, 46, 0.75).collect()]
    # Few of the others stay, by chance: half of their shingles are not looked at.
    assert {40, 41, 42} <= set(left) and len(set(left)) == len(left) < 15
    assert passages.likely(kept.limit(0), 46, 0.75).count() == 0


def test_texts_go_only_to_cells_where_they_have_a_pair_to_search():
    rows = [(1, 0, 0, 0, fp, [1, 2, 3]) for fp in (5, 6)] + [(2, 0, 0, 0, fp, [1, 2, 3]) for fp in (5, 6)]
    rows += [(3, 0, 1, 0, 5, [1, 2, 3]), (3, 0, 1, 0, 6, [1, 2, 3]), (3, 0, 1, 1, 7, [2, 3]), (3, 0, 1, 1, 8, [3])]
    kinds = [("key", pa.int64()), ("i", pa.int32()), ("j", pa.int32()), ("part", pa.int32()), ("fp", pa.int64()), ("keys", pa.list_(pa.int64()))]
    batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(zip(*rows, strict=True), kinds, strict=True)], [n for n, _ in kinds])
    got = [tuple(r.values()) for b in passages._needed(iter([batch])) for r in b.to_pylist()]
    # 5 and 6 meet at key 1 already, 7 at key 2 with both; only 8 has pairs to search at key 3.
    assert got == [(1, 0, 0, 0, 5), (1, 0, 0, 0, 6), (3, 0, 1, 0, 5), (3, 0, 1, 0, 6), (3, 0, 1, 1, 8)]


@pytest.mark.parametrize("at", range(50))
def test_passages_with_a_changed_word_are_decided_by_similarity(at):
    rng = np.random.default_rng(at)
    one, two = rng.integers(1, 2**62, (2, 140)).astype(np.uint64)
    two[30:76] = one[50:96]
    # Word `at` of 50 differs: five of the shingles, or fewer at the ends.
    two[30 + max(0, at - 4) : 30 + min(45, at) + 1] += np.uint64(1)
    found = passages.stretches(one, two, 46, 0.75)
    assert [(s <= 60 and e >= 85 and t <= 40 and f >= 65) for s, e, t, f, _ in found] == [True]
    for s, e, t, f, share in found:
        a, b = set(one[s : e + 1].tolist()), set(two[t : f + 1].tolist())
        assert min(e - s, f - t) >= 45 and len(a & b) / len(a | b) == pytest.approx(share) and share >= 0.75


def test_each_occurrence_of_a_passage_is_found():
    one, two = np.random.default_rng(1).integers(1, 2**62, (2, 300)).astype(np.uint64)
    two[10:70] = two[200:260] = one[100:160]
    assert [(t, f) for _, _, t, f, _ in passages.stretches(one, two, 46, 0.75)] == [(10, 69), (200, 259)]
    assert passages.stretches(one, two[70:200], 46, 0.75) == []


def test_windows_cover_each_long_subsequence_once():
    rng = np.random.default_rng(5)
    for hashes in (rng.integers(0, 50, 60), rng.permutation(60), np.zeros(60, int)):
        found = passages.windows(hashes, 8)
        for i in range(60):
            for j in range(i + 7, 60):
                holding = [(a, c, b) for a, c, b in found if a <= i <= c <= j <= b]
                assert len(holding) == 1 and hashes[holding[0][1]] == hashes[i : j + 1].min()


@pytest.mark.parametrize("hot", [2000, 3])
def test_repeated_substrings(spark, hot):
    rnd = random.Random(31)
    parts = ["".join(rnd.choice("abcé") for _ in range(70)) for _ in range(4)]
    rows = [(1, None, None), (2, "", None), (3, "a" * 300, None), (4, "ab" * 60, None), (5, "a" * 41, None), (None, parts[0], None)]
    for i in range(60):
        text = "".join(rnd.choice("defgh") for _ in range(rnd.randrange(0, 90)))
        for _ in range(rnd.randrange(0, 4)):
            a = rnd.randrange(0, 40)
            text += rnd.choice(parts)[a : a + rnd.randrange(10, 70)] + "".join(rnd.choice("xyz") for _ in range(rnd.randrange(0, 9)))
        rows.append((10 + i, text, None))
    rows += [(100, rows[20][1], None), (20, rows[20][1], None)]
    found = suffixes.without_repeats(frame(spark, rows), 40, 10, hot_from=hot).collect()
    got = [(r.doc_id, r.n_bytes, sum(s.stop - s.start for s in r.spans), len(r.spans), hashlib.sha256(r.kept).hexdigest()) for r in found]
    assert in_order(got) == in_order(repeat_results(rows, 40))


def test_repeated_substrings_that_end_in_nul(spark):
    """Texts that differ only in NUL bytes at an end are different."""
    rnd = random.Random(17)
    parts = ["".join(rnd.choice("ab\0") for _ in range(14)) for _ in range(3)]
    rows = [(i, "".join(rnd.choice([rnd.choice(parts), "\0" * rnd.randrange(1, 9), rnd.choice("ab"), "\0"]) for _ in range(rnd.randrange(1, 9))), None) for i in range(300)]
    rows += [(400, "x" * 12, None), (401, "x" * 12 + "\0", None), (402, "x" * 12 + "\0\0", None), (403, "\0" * 30, None)]
    found = suffixes.without_repeats(frame(spark, rows), 12, 4).collect()
    got = [(r.doc_id, r.n_bytes, sum(s.stop - s.start for s in r.spans), len(r.spans), hashlib.sha256(r.kept).hexdigest()) for r in found]
    assert in_order(got) == in_order(repeat_results(rows, 12))


def test_offsets_of_anchors_with_nul_bytes():
    rnd = random.Random(23)
    for _ in range(600):
        n = rnd.randrange(2, 7)
        pick = lambda most: bytes(rnd.choice(b"\0\0a") for _ in range(rnd.randrange(most)))
        before, after = [pick(4) for _ in range(n)], [b"g" + pick(4) for _ in range(n)]
        if len(set(zip(before, after, strict=True))) < n:
            continue
        twice = np.array([rnd.random() < 0.2 for _ in range(n)])
        found = suffixes.repeated_offsets(before, after, twice, 4, 1)
        for i in range(n):
            string = lambda k, o: before[k][len(before[k]) - o :] + after[k][: 4 - o] if o <= len(before[k]) and 4 - o <= len(after[k]) else None
            want = {o for o in range(4) if string(i, o) is not None and (twice[i] or any(string(k, o) == string(i, o) for k in range(n) if k != i))}
            assert {o for a, b in found[i] for o in range(a, b + 1)} == want


def test_repeated_substrings_at_full_length_and_of_nothing(spark):
    rows = edge_rows()
    docs = frame(spark, rows)
    found = suffixes.without_repeats(docs).collect()
    got = [(r.doc_id, r.n_bytes, sum(s.stop - s.start for s in r.spans), len(r.spans), hashlib.sha256(r.kept).hexdigest()) for r in found]
    assert in_order(got) == in_order(repeat_results(rows, 400))
    assert suffixes.without_repeats(docs.limit(0)).count() == 0


def test_levels_grow_geometrically(spark):
    family = suffixes.SuffixFamily(spark)
    for number in range(3):
        family.add(spark.createDataFrame([(1, number, False), (100 + number, number, number == 2)], "gram long, tid long, twice boolean"))
    assert [size for size, _ in family.levels] == [2, 1]
    assert in_order(map(tuple, family.repeated().collect())) == [(1, 0), (1, 1), (1, 2), (102, 2)]


def test_encoding_is_that_of_tiktoken(spark):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = bpe.read_ranks(path)
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rnd = random.Random(2)
    odd = "".join(chr(rnd.choice([rnd.randrange(1, 128), rnd.randrange(128, 0xD7FF), rnd.randrange(0x10000, 0x10FFFF)])) for _ in range(3000))
    rows = edge_rows() + [(90, "I'll  see\n\n 12345 <|endoftext|>  ", None), (91, odd, None), (92, "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaab" * 40, None)]
    docs = frame(spark, rows)
    got = bpe.decode(bpe.encode(docs, path, public_tokenizers.PATTERN), path).collect()
    want = []
    for i, t, _ in rows:
        ids = own.encode_ordinary(t or "")
        want.append((i, len(ids), np.array(ids, "<u4").tobytes(), (t or "").encode()))
    assert in_order((r.doc_id, r.n_tokens, bytes(r.ids), bytes(r.decoded)) for r in got) == in_order(want)
    assert bpe.encode(docs.limit(0), path, public_tokenizers.PATTERN).count() == 0


def test_slices_keep_what_is_made_of_a_batch_small():
    parts = list(bpe.slices(pa.RecordBatch.from_pydict({"x": list(range(1001))})))
    assert max(p.num_rows for p in parts) <= 200 and [x for p in parts for x in p.column("x").to_pylist()] == list(range(1001))


def test_rounds_without_pairs_read_no_documents(spark, monkeypatch):
    reads = []
    monkeypatch.setattr(jaccard, "id_bits", lambda *a: reads.append(a))
    base = " ".join(f"w{i}" for i in range(12))
    docs = frame(spark, [(1, base, None), (2, base, None), (3, " ".join(f"v{i}" for i in range(12)), None), (4, None, None)])
    assert in_order(tuple(r) for r in jaccard.near_duplicates(docs).select("doc_id", "component_id").collect()) == [(1, 1), (2, 1), (3, 3), (4, 4)]
    assert not reads


def test_texts_are_decoded_in_the_pass_that_encodes_them(spark):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    docs = frame(spark, edge_rows())
    encoded = bpe.encode(docs, path, public_tokenizers.PATTERN)
    both = bpe.decode(encoded, path)
    assert both._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    # Ids that come from elsewhere are decoded alike.
    assert in_order(map(tuple, both.collect())) == in_order(map(tuple, bpe.decode(encoded.select("*"), path).collect()))


def test_pieces_met_once_do_not_drive_out_common_ones(monkeypatch):
    monkeypatch.setattr(bpe, "ONCE", 20)
    monkeypatch.setattr(bpe, "REMEMBERED", 20)
    made = []
    known = bpe.Known(lambda piece: made.append(piece) or piece.encode())
    for i in range(500):
        assert [known[x] for x in ("the", f"rare{i}", "the")] == [b"the", b"rare%d" % i, b"the"]
        known.trim()
        assert len(known) + len(known.fresh) + len(known.older) <= 50
    assert made.count("the") == 1 and len(made) == 501


def test_pieces_are_remembered_from_one_batch_to_the_next(monkeypatch):
    ranks = {bytes([i]): i for i in range(256)} | {b"ab": 256}
    encoder = bpe.Encoder(ranks, r"\w+|\s")
    merged, made = encoder.merged, []
    encoder.merged = lambda piece: made.append(piece) or merged(piece)
    for _ in range(3):
        assert [np.frombuffer(x, "<u4").tolist() for x in encoder.texts(["abc", "abc xyz"])] == [[256, 99], [256, 99, 32, 120, 121, 122]]
    assert made == [b"abc", b"xyz"]
    del encoder.merged
    other = pickle.loads(pickle.dumps(encoder))
    assert not other.known and not other.known.fresh and list(other.texts(["abc"])) == list(encoder.texts(["abc"]))
    # What is remembered stays bounded, also of pieces that are met again.
    monkeypatch.setattr(bpe, "ONCE", 20)
    monkeypatch.setattr(bpe, "REMEMBERED", 20)
    for i in range(500):
        list(other.texts([f"ab{i} ab{i}"]))
        known = other.known
        assert len(known) + len(known.past) + len(known.fresh) + len(known.older) <= 60


def test_perfect_hash_is_minimal():
    keys = [f"key{i}".encode() for i in range(5000)]
    table = bpe.PerfectHash(keys)
    assert [table(k) for k in keys] == list(range(5000)) and sorted(table.slots) == list(range(5000))
