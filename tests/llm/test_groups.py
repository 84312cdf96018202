"""Operators 6, 7 and 9: near-duplicates and repeated passages against brute force."""

import hashlib
import math
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from relcast.llm import common, embeddings, minhash, suffix


def reach(nodes, links):
    least = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            m = min(least[a], least[b])
            if least[a] != m or least[b] != m:
                least[a] = least[b] = m
                changed = True
    return least


def test_connected_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 90), (95, 100), (7, 7), (None, 3), (200, 201), (201, 200)]
    got = {r.node: r.component for r in common.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    real = [(a, b) for a, b in edges if a is not None and a != b]
    want = reach({x for e in real for x in e}, real)
    assert got == want
    assert common.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def plain_set(text, size=2):
    words = (text or "").encode().lower().split()
    return {tuple(words[i:i + size]) for i in range(len(words) - size + 1)} if len(words) > size else {tuple(words)} if words else set()


def plain_near(rows, size=2):
    """The smallest doc_id reachable from every row; rows without an id are linked with nothing."""
    sets = [plain_set(r["text"], size) if r["doc_id"] is not None else set() for r in rows]
    links = [(i, j) for i, x in enumerate(sets) for j, y in enumerate(sets[:i]) if x and y and 100 * len(x & y) >= 80 * len(x | y)]
    parts = reach(range(len(rows)), links)
    least = {}
    for i, r in enumerate(rows):
        if r["doc_id"] is not None:
            least[parts[i]] = min(least.get(parts[i], r["doc_id"]), r["doc_id"])
    return [least.get(parts[i]) for i in range(len(rows))], parts


def check_near(docs, rows_of):
    rows = rows_of(docs)
    least, _ = plain_near(rows)
    want = Counter((r["doc_id"], len(plain_set(r["text"])), c, r["doc_id"] == c) for r, c in zip(rows, least))
    got = Counter((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in rows_of(minhash.op6_query(docs)))
    assert got == want


def test_near_duplicates_match_brute_force(edge_docs, no_docs, rows_of):
    check_near(edge_docs, rows_of)
    assert minhash.op6_query(no_docs).count() == 0


def test_near_duplicates_around_the_threshold(spark, rows_of):
    """A dense group around 0.8, so that buckets stay open after the first comparison."""
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in range(60)]
    docs = []
    for i in range(150):
        words = list(base)
        for at in rng.choice(60, rng.integers(0, 9), replace=False):
            words[at] = f"v{rng.integers(0, 5)}x{at}"
        docs.append((i, " ".join(words)))
    check_near(spark.createDataFrame(docs, "doc_id long, text string"), rows_of)


def test_blocks_of_open_groups(spark, rows_of, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK_DOCS", 7)
    test_near_duplicates_around_the_threshold(spark, rows_of)


def drifting(spark, n):
    """A template of which some words change from document to document: neighbours share buckets and are hardly linked, far ones are strangers."""
    rng = np.random.default_rng(8)
    words, docs = [f"w{i}" for i in range(80)], []
    for i in range(n):
        for at in rng.choice(80, 4 + i % 2, replace=False):
            words[at] = f"v{i}x{at}"
        docs.append((i, " ".join(words)))
    return spark.createDataFrame(docs, "doc_id long, text string").repartition(4)


def test_drifting_groups_are_compared_bucket_by_bucket(spark, monkeypatch):
    """Comparisons grow as the pairs inside buckets do, not with the square of the chain."""
    seen, units = [], minhash._units

    def watched(labelled):
        members, stats = units(labelled)
        rows = stats.collect()
        seen.append((sum(r.comparisons for r in rows), {r.kind for r in rows}))
        return members, stats

    monkeypatch.setattr(minhash, "_units", watched)
    monkeypatch.setattr(minhash, "CARRY", 0)  # by comparisons alone
    for n in (300, 600):
        minhash.components(drifting(spark, n), size=2).count()
    assert 1 in seen[1][1] and seen[1][0] < 2.6 * seen[0][0] and seen[1][0] < 600 * 30


def test_both_ways_of_comparing_groups_agree(spark, rows_of, monkeypatch):
    for carry in (0, 10**9):  # always bucket by bucket, never
        monkeypatch.setattr(minhash, "CARRY", carry)
        check_near(drifting(spark, 120), rows_of)


def test_short_texts(spark, rows_of):
    texts = ["a b c d e", "a b c d e f", "a b c d", "a", "A", "a a", "a a a", "", "b a", "x y z w v", "x y z w v u"]
    check_near(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), rows_of)


def repeated_ids(spark, partitions):
    """An id on linked texts, on texts of different groups, and on equal ones; columns with helper-like names."""
    words = [f"w{i}" for i in range(40)]
    a, b, c = " ".join(words), " ".join(reversed(words)), " ".join(words[::2])
    near = lambda text: text + " more"
    rows = [(5, a), (3, a), (5, b), (9, b), (9, near(b)), (4, near(a)), (7, c), (7, near(c)), (7, c), (2, c), (2, c), (2, near(c)), (1, "alone"), (1, "alone"), (None, a), (None, a), (6, None), (6, "")]
    return spark.createDataFrame([(i, t, k, k, k, k, k, k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, _gone int, row int, gone int, _row int, id int, digest int").repartition(partitions)


@pytest.mark.parametrize("partitions", [1, 2, 3, 7])
def test_ids_on_several_texts(spark, rows_of, partitions):
    docs = repeated_ids(spark, partitions)
    check_near(docs, rows_of)
    rows = rows_of(docs)
    _, parts = plain_near(rows)
    kept = minhash.keep_documents(docs, size=2)
    assert kept.schema == docs.schema
    got = {r["_gone"] for r in rows_of(kept)}
    groups = {}
    for i, r in enumerate(rows):
        groups.setdefault(parts[i], []).append(r)
    for members in groups.values():  # one row of each group stays, with the smallest id: no text is lost
        left = [r for r in members if r["_gone"] in got]
        assert len(left) == 1 and left[0]["doc_id"] == min((r["doc_id"] for r in members), key=lambda i: (i is None, i))


def test_circulant_table_is_a_permutation():
    table = minhash.circulant_table(16)
    size = 1 << minhash.UNIVERSE_BITS
    assert len(np.unique(table[:size])) == size and (table[size:] == table[:16]).all()


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 2**63, 400, dtype=np.uint64)
    for share in (0.5, 0.8, 0.95):
        n = round(400 * 2 * share / (1 + share))
        y = np.concatenate([x[:n], rng.integers(0, 2**63, 400 - n, dtype=np.uint64)])
        same = (minhash.signature(x, 1024) == minhash.signature(y, 1024)).mean()
        assert abs(same - share) < 0.06


def test_kept_documents(edge_docs):
    kept = minhash.keep_documents(edge_docs)
    assert kept.columns == edge_docs.columns
    ids = Counter(r.doc_id for r in kept.collect())
    assert ids[1] == 1 and not {2, 3, 8, 19} & set(ids) and ids[None] == 2 and ids[4] == 1


def test_stage_links_on_five_words(spark):
    """Texts of 200 words with scattered changes: from 5 changes on, shingles of two words would still link most of them."""
    base = [f"w{i}" for i in range(200)]
    docs = []
    for i, changes in enumerate([0, 1, 2, 3, 4, 5, 6, 8, 10, 12]):
        words = list(base)
        for k in range(changes):
            words[10 + 15 * k] = f"v{i}x{k}"
        docs.append((i, " ".join(words)))
    grams = lambda text: set(zip(*(text.split()[k:] for k in range(5))))
    sets = [(i, grams(t)) for i, t in docs]
    parts = reach([i for i, _ in docs], [(a, b) for a, x in sets for b, y in sets if a < b and 100 * len(x & y) >= 80 * len(x | y)])
    table = spark.createDataFrame(docs, "doc_id long, text string")
    kept = {r.doc_id for r in dict(corpus_pipeline.STAGES)["near_duplicates"](spark, table, "").collect()}
    assert kept == {i for i, c in parts.items() if i == c} and {0, 8, 9} <= kept and 1 not in kept


# --------------------------------------------------------------- embeddings

def plain_links(rows):
    out = []
    units = []
    for r in rows:
        v = r["embedding"]
        ok = r["vec_id"] is not None and r["label"] is not None and v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)
        w = np.array(v, np.float64) if ok else None
        units.append(w / np.linalg.norm(w) if ok else None)
    for i, (r, u) in enumerate(zip(rows, units)):
        for j in range(i):
            if u is not None and units[j] is not None and rows[j]["label"] == r["label"] and len(u) == len(units[j]) and float(u @ units[j]) >= embeddings.COSINE:
                out.append((i, j))
    return out


def vectors(spark):
    rng = np.random.default_rng(1)
    rows, vec = [], 0
    for _ in range(40):
        centre = rng.normal(size=16)
        for _ in range(rng.integers(1, 6)):
            rows.append((vec, (centre + rng.normal(size=16) * 0.05).tolist(), int(vec % 2)))
            vec += 1
    same = rng.normal(size=16).tolist()
    rows += [(1000 + i, same, 1) for i in range(5)] + [(1010, same, None), (1011, same, 0)]
    rows += [(2000, None, 1), (2001, [0.0] * 16, 1), (2002, [float("nan")] + [1.0] * 15, 1), (2003, [float("inf")] + [1.0] * 15, 1), (2004, [None] + [1.0] * 15, 1)]
    rows += [(2005, [], 1), (2006, [1.0, 2.0], 1), (2007, [1.0, 2.0], 1), (2008, [1e-40] * 16, 1), (2009, [1e30] * 16, 1), (None, same, 1), (3000, same, 1), (3000, same, 1)]
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<float>, label int, kept string, links int").repartition(3)


def plain_vectors(rows, pairs, links):
    parts, least = reach(range(len(rows)), pairs), {}
    for i, r in enumerate(rows):
        if r["vec_id"] is not None:
            least[parts[i]] = min(least.get(parts[i], r["vec_id"]), r["vec_id"])
    return Counter((r["vec_id"], links[i], least.get(parts[i]), r["vec_id"] == least.get(parts[i])) for i, r in enumerate(rows))


@pytest.mark.parametrize("partitions", [1, 2, 3, 7])
def test_ids_on_several_vectors(spark, rows_of, partitions):
    a, near_a, b = [1.0, 0.0, 0.1], [1.0, 0.0, 0.11], [0.0, 1.0, 0.0]
    rows = [(1, a, "x"), (1, b, "x"), (2, near_a, "x"), (1, a, "y"), (3, b, "x"), (0, b, "y"), (2, near_a, "y"), (2, near_a, "y"), (4, [0.0, 0.0, 1.0], "x")]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string").repartition(partitions)
    rows = rows_of(table)
    pairs = plain_links(rows)
    want = plain_vectors(rows, pairs, Counter(x for p in pairs for x in p))
    assert Counter((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in rows_of(embeddings.op7_query(table))) == want


@pytest.mark.parametrize("block", [512, 5])
def test_embeddings_match_brute_force(spark, rows_of, block):
    table = vectors(spark)
    rows = rows_of(table)
    pairs = plain_links(rows)
    links = Counter(x for p in pairs for x in p)
    want = plain_vectors(rows, pairs, links)
    got = Counter((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in rows_of(embeddings.components(table, embeddings.Index(block=block))))
    assert got == want
    assert embeddings.op7_query(table.where("false")).count() == 0


# ------------------------------------------------------------ repeated passages

def plain_removed(rows):
    first = {}
    data = [(r["doc_id"], (r["text"] or "").encode()) for r in rows]
    n = suffix.LENGTH
    for d, b in data:
        if d is not None:
            for i in range(len(b) - n + 1):
                s = b[i:i + n]
                first[s] = min(first.get(s, d), d)
    out = Counter()
    for d, b in data:
        gone = bytearray(len(b))
        if d is not None:
            for i in range(len(b) - n + 1):
                if first[b[i:i + n]] < d:
                    gone[i:i + n] = b"\x01" * n
        runs = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out[(d, len(b), sum(gone), runs, hashlib.sha256(bytes(c for c, g in zip(b, gone) if not g)).hexdigest())] += 1
    return out


def got_removed(df):
    return Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect())


def test_passages_match_brute_force(edge_docs, no_docs, rows_of):
    assert got_removed(suffix.op9_query(edge_docs)) == plain_removed(rows_of(edge_docs))
    assert suffix.op9_query(no_docs).count() == 0


def test_hot_anchors_string_by_string(spark, rows_of, monkeypatch):
    """With a limit of one batch, shared anchors are hot and go string by string; the result is the same."""
    rng = np.random.default_rng(2)
    passage = "".join(rng.choice(list("abcdefgh "), 140))
    word = lambda: "".join(rng.choice(list("abcdefgh "), rng.integers(0, 90)))
    docs = spark.createDataFrame([(i, word() + passage[rng.integers(0, 40):rng.integers(80, 140)] + word()) for i in range(60)], "doc_id long, text string").repartition(8)
    want = plain_removed(rows_of(docs))
    assert got_removed(suffix.op9_query(docs)) == want
    monkeypatch.setattr(suffix, "HOT_SHARE", 0.0)
    frame = suffix.deduplicate(docs, hot_batches=1)
    assert sum(r.n_bytes - len(r.kept) for r in frame.collect()) == sum(n * k[2] for k, n in want.items())


def test_anchors_depend_on_content_only():
    rng = np.random.default_rng(4)
    text = rng.integers(0, 256, 400, dtype=np.uint8).tobytes()
    other = rng.integers(0, 256, 37, dtype=np.uint8).tobytes() + text
    assert (suffix.anchors(other)[37:] == suffix.anchors(text)).all()
    assert len(suffix.anchors(text)) == 400 - suffix.LENGTH + 1
    assert [len(a) for a in suffix.anchored([text, b"", b"x" * 49, text[:50]])] == [351, 0, 0, 1]
