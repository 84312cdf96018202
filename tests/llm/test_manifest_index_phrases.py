"""Operators 11, 12 and 13 against plain versions."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from relcast.llm import common, cuckoo, merkle, phrases

# ------------------------------------------------------------------ manifest

H = lambda *parts: hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row, text):
    out = ""
    for v in (row["doc_id"], row["source"], row["lang"], row["n_chars"], text):
        out += "-" if v is None else f"{len(str(v).encode())}:{v}"
    return H(out)


def plain_tree(digests):
    levels = [digests]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([H(*below[i:i + 16]) for i in range(0, len(below), 16)])
    return levels


def plain_fold(levels, at, digest):
    siblings = ""
    for level in levels[:-1]:
        first = at // 16 * 16
        run = level[first:first + 16]
        siblings += "".join(run[:at - first] + run[at - first + 1:])
        digest = H(*run[:at - first], digest, *run[at - first + 1:])
        at //= 16
    return siblings, digest


def plain_manifest(rows):
    by_source = defaultdict(list)
    for r in rows:
        by_source[r["source"]].append((r["doc_id"] is not None, r["doc_id"] or 0, plain_leaf(r, r["text"]), r))
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        by_source[s].sort(key=lambda x: x[:3])
        trees[s] = plain_tree([x[2] for x in by_source[s]])
    top = plain_tree([trees[s][-1][0] for s in names])
    out = Counter()
    for k, s in enumerate(names):
        for i, (_, _, own, r) in enumerate(by_source[s]):
            text = r["text"]
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 and text is not None:
                text = re.sub("[A-Z]", lambda m: m[0].lower(), text)
            below, digest = plain_fold(trees[s], i, plain_leaf(r, text))
            above, digest = plain_fold(top, k, digest)
            out[r["doc_id"], own, trees[s][-1][0], top[-1][0], H(below, above), digest, digest == top[-1][0]] += 1
    return out


def got_manifest(df):
    return Counter((r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) for r in df.collect())


def test_manifest_matches_plain_trees(edge_docs, no_docs, rows_of):
    assert got_manifest(merkle.op11_query(edge_docs)) == plain_manifest(rows_of(edge_docs))
    assert merkle.op11_query(no_docs).count() == 0


def test_manifest_of_one_row_and_of_many_blocks(spark, rows_of):
    schema = "doc_id long, text string, lang string, source string, n_chars long, pos int, block int, sid int, _uid int"
    one = spark.createDataFrame([(7, "Only", "en", "s", 4, 0, 0, 0, 0)], schema)
    assert got_manifest(merkle.op11_query(one)) == plain_manifest(rows_of(one))
    # a source of 8193 leaves: three blocks, the last with a single leaf that is hashed level by level
    rows = [(i, f"Text {i}", "en", "hot", i, 1, 1, 1, 1) for i in range(8193)]
    rows += [(10**17 + i, "T", None, f"s{i % 37}", None, 1, 1, 1, 1) for i in range(90)] + [(None, "T", "en", None, 1, 1, 1, 1, 1)] * 2
    docs = spark.createDataFrame(rows, schema).repartition(5)
    got = got_manifest(merkle.op11_query(docs))
    assert got == plain_manifest(rows_of(docs))
    assert 0 < sum(n for r, n in got.items() if not r[-1]) < len(rows) / 4


def test_parent_resumes_the_state_of_a_slot():
    children = [H(str(i)) for i in range(16)]
    parent = merkle.Parent(children)
    assert parent.digest == H(*children) and len(parent.states) == 16
    for slot in range(16):
        changed = list(children)
        changed[slot] = H("other")
        assert parent.fold(slot, changed[slot]) == H(*changed) and parent.fold(slot, children[slot]) == parent.digest


# --------------------------------------------------------------- exact dedup

def test_filter_holds_what_was_inserted_and_not_deleted():
    rng, live, index = random.Random(1), set(), cuckoo.CuckooFilter(4)
    sizes = set()
    for step in range(20_000):
        key = hashlib.sha256(str(rng.randrange(4000)).encode()).digest()
        if key in live and rng.random() < 0.6:
            assert index.delete(key) >= 0
            live.remove(key)
        elif key not in live:
            assert index.find(key) == -1
            index.insert(key)
            live.add(key)
        sizes.add(index.buckets)
        assert len(index) == len(live)
    keys = [hashlib.sha256(str(i).encode()).digest() for i in range(4000)]
    assert all((index.find(k) >= 0) == (k in live) for k in keys) and all(index.may_hold(k) for k in live)
    assert len(sizes) > 3 and index.delete(b"\0" * 32) == -1


def test_hits_are_verified_against_the_stored_keys():
    index = cuckoo.CuckooFilter()
    key = hashlib.sha256(b"x").digest()
    twin = key[:10] + bytes(22)  # same fingerprint, same buckets
    index.insert(key)
    assert index.may_hold(twin) and index.find(twin) == -1
    index.insert(twin)
    index.delete(key)
    assert index.find(twin) >= 0 and index.find(key) == -1


def plain_copies(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", r["text"] or "")].append(r["doc_id"])
    out = Counter()
    for text, ids in groups.items():
        ids.sort(key=lambda i: (i is None, i or 0))
        for k, i in enumerate(ids):
            out[i, ids[0], len(ids), k == 0, hashlib.sha256(text.encode()).hexdigest()] += 1
    return out


def got_copies(df):
    return Counter((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in df.collect())


@pytest.mark.parametrize("shard_keys", [1 << 16, 9])
def test_copies_match_plain_groups(edge_docs, no_docs, rows_of, monkeypatch, shard_keys):
    monkeypatch.setattr(cuckoo, "SHARD_KEYS", shard_keys)
    assert got_copies(cuckoo.op12_query(edge_docs)) == plain_copies(rows_of(edge_docs))
    assert cuckoo.op12_query(no_docs).count() == 0


def test_one_row_of_each_text_stays(spark, edge_docs, rows_of):
    docs = edge_docs.withColumnRenamed("kept", "uid").withColumnRenamed("spans", "_kept")
    kept = cuckoo.keep_documents(docs)
    assert kept.schema == docs.schema
    squeezed = lambda rows: Counter(re.sub(r"[\x20\x09-\x0D]+", " ", r["text"] or "") for r in rows)
    assert squeezed(rows_of(kept)) == Counter(set(squeezed(rows_of(docs))))


def test_index_follows_insertions_and_deletions(spark):
    rng = random.Random(3)
    texts = [f"text {i}" for i in range(12)]
    rows = [(uid, None if uid % 17 == 0 else 100 - uid, rng.choice(texts) + ("  " if uid % 3 else " ")) for uid in range(80)]
    table = lambda part: common.written(cuckoo.keyed(spark.createDataFrame(part, "uid long, doc_id long, text string"), common.F.col("uid")), "t")

    def check(index, live):
        want = plain_copies([{"doc_id": d, "text": t} for _, d, t in live])
        assert got_copies(cuckoo.classes(index)) == want
        assert index.entries.count() == len({t.strip() for _, _, t in live})

    index = cuckoo.build(table(rows[:50]))
    check(index, rows[:50])
    index = cuckoo.insert(index, table(rows[50:]))
    check(index, rows)
    gone = {u for u, _, t in rows if t.strip() in texts[:3]} | set(rng.sample(range(80), 30))
    index = cuckoo.delete(index, spark.createDataFrame([(u,) for u in gone] + [(999,)], "uid long"))
    left = [r for r in rows if r[0] not in gone]
    check(index, left)
    back = [(1000 + u, d, t) for u, d, t in rows if u in gone]
    check(cuckoo.insert(index, table(back)), left + back)


# ------------------------------------------------------------------- phrases

def plain_phrases(rows, support, longest=5, top=2000):
    counts, words = defaultdict(Counter), Counter()
    for r in rows:
        lang = "und" if r["lang"] is None else r["lang"]
        text = re.sub("[A-Z]", lambda m: m[0].lower(), r["text"] or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            w = re.findall(r"[^\x20\x09]+", piece)
            words[lang] += len(w)
            for k in range(1, longest + 1):
                counts[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, f in counts.items():
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= support}
        best = []
        for p, a in found.items():
            if any(len(q) > len(p) and b >= a and any(q[i:i + len(p)] == p for i in range(len(q))) for q, b in found.items()):
                continue
            score, _, l, r = min((1000 * a * words[lang] // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            best.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (s, a, p, l, r) in enumerate(sorted(best)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, words[lang], -s))
    return sorted(out)


def got_phrases(df):
    return sorted((r.lang, r.rank, r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect())


@pytest.mark.parametrize("shards, size, groups", [(1, 1 << 22, 256), (8, 60, 3)])
def test_phrases_match_plain_counts(edge_docs, no_docs, rows_of, monkeypatch, shards, size, groups):
    """Also with slices of a few words and buffers of three groups."""
    monkeypatch.setattr(phrases, "SLICE", size)
    monkeypatch.setattr(phrases, "BUFFER", 500 if groups == 3 else 1 << 22)
    if groups == 3:
        monkeypatch.setattr(phrases, "_few_groups", lambda batches: ((b.slice(i, 1), [tuple(b.column(k)[i].as_py() for k in range(3))]) for b in batches for i in range(b.num_rows)))
    want = plain_phrases(rows_of(edge_docs), 4, top=60)
    assert got_phrases(phrases.collocations(edge_docs, support=4, top=60, shards=shards)) == want and len(want) == 60
    assert phrases.op13_query(no_docs).count() == 0


def test_phrases_of_several_languages(spark, rows_of):
    rng = random.Random(6)
    stock = ["New York", "new york city", "état de l'art", "a b", "b a b a b", "one two three four five six", "x"]
    ends = [" ", "  ", "\t", ". ", ",", "\n", " \r\n", ";", "!", " \x1c ", " "]
    rows = [("".join(rng.choice(stock) + rng.choice(ends) for _ in range(rng.randint(0, 40))), rng.choice(["en", "fr", None, "und"]), 1, 2) for _ in range(120)]
    rows += [(None, "en", 1, 2), ("", None, 1, 2), ("only", "de", 1, 2), (rows[0][0], "fr", 1, 2), (rows[0][0], "fr", 1, 2)]
    docs = spark.createDataFrame(rows, "text string, lang string, hash int, n int").repartition(5)
    for support in (2, 9, 40):
        assert got_phrases(phrases.collocations(docs, support=support)) == plain_phrases(rows_of(docs), support)
    assert phrases.collocations(docs, support=10**6).count() == 0


def test_slices_end_between_pieces():
    import numpy as np
    import pyarrow as pa

    rng = random.Random(2)
    texts = ["".join(rng.choice(["word ", "a", "é", ". ", "\n", " "]) for _ in range(rng.randint(0, 60))) for _ in range(40)] + [None, "", "x" * 300, "tail"]
    data, bounds = phrases.bytes_of(pa.array(texts))
    whole = phrases.Words(data, bounds, 0, len(data))
    words = lambda w, base: [(base + a, base + b, t) for a, b, t in zip(w.start, w.end, w.text)]
    for size in (1, 7, 50, 10**6):
        got, hashes, at = [], [], 0
        for a, b in phrases.slices(data, bounds, size):
            assert a == at and b > a
            at = b
            part = phrases.Words(data, bounds, a, b)
            got += words(part, a)
            hashes += part.hash.tolist()
        assert at == len(data) and got == words(whole, 0) and hashes == whole.hash.tolist()
    plain = [w for t in texts for w in re.findall(rb"[^ \n]+", phrases._MAPPED[np.frombuffer((t or "").encode(), np.uint8)].tobytes())]
    assert [whole.word(i) for i in range(len(whole))] == plain
    numbers = whole.numbers()
    assert len(set(zip(numbers, plain))) == len(set(plain)) == len(set(numbers))


def test_scores_are_exact_beyond_64_bits(spark, monkeypatch):
    """1000 * a * n of these counts passes 2 ** 64."""
    a, n = 3 * 10**12 + 7, 10**15 + 3
    counted = spark.createDataFrame([("en", "x y", 2, a), ("en", "x", 1, a + 5), ("en", "y", 1, a + 11)], "lang string, phrase string, m int, n long")
    totals = spark.createDataFrame([("en", n)], "lang string, n long")
    monkeypatch.setattr(phrases, "frequent", lambda *_: (counted, totals))
    assert phrases.collocations(None).first().score == 1000 * a * n // ((a + 5) * (a + 11))


def test_bitmap_holds_its_hashes(spark):
    import numpy as np

    values = np.random.default_rng(0).integers(0, 2**64, 5000, dtype=np.uint64)
    keys = [int(v) >> 64 - phrases.HASH_BITS << phrases.SHARD_BITS | i % 8 for i, v in enumerate(values)]
    bits = phrases.bitmap(spark.createDataFrame([(k,) for k in keys], "key long"))
    assert phrases.in_bitmap(bits, values).all()
    others = np.random.default_rng(1).integers(0, 2**64, 5000, dtype=np.uint64)
    assert phrases.in_bitmap(bits, others).mean() < 0.01
