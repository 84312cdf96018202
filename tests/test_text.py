import random

import duckdb
from pyspark.sql import functions as F

from relcast.functions.text import split_ids, within_edits2


def test_edit_predicate_matches_damerau_levenshtein(spark):
    rnd = random.Random(7)
    alphabet = "abc"
    pairs = set()
    while len(pairs) < 1500:
        a = "".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 5)))
        b = "".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 5)))
        pairs.add((a, b))
    pairs = sorted(pairs)
    df = spark.createDataFrame(pairs, "a string, b string")
    got = {(r.a, r.b): r.w for r in df.select("a", "b", within_edits2("a", "b").alias("w")).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE p (a VARCHAR, b VARCHAR)")
    con.executemany("INSERT INTO p VALUES (?, ?)", pairs)
    want = {(a, b): w for a, b, w in con.execute("SELECT a, b, damerau_levenshtein(a, b) < 3 FROM p").fetchall()}
    assert got == want


def test_split_ids_drops_empty(spark):
    df = spark.createDataFrame([("111 222",), ("111  222",), (None,)], "v string")
    assert [r[0] for r in df.select(split_ids("v")).collect()] == [["111", "222"], ["111", "222"], None]


def test_candidate_search_is_exact_for_short_and_long_words(spark):
    from relcast.operators.categories import typo_candidates

    rnd = random.Random(11)
    words = set()
    base = ["abcabcabcab", "bacbacbacba", "aabbccaabbc", "cabcabcabca"]
    for w in base:
        words.add(w)
        for _ in range(60):
            s = list(w)
            for _ in range(rnd.randint(1, 3)):
                op = rnd.choice("dist")
                p = rnd.randrange(len(s))
                if op == "d" and len(s) > 4:
                    s.pop(p)
                elif op == "i":
                    s.insert(p, rnd.choice("abc"))
                elif op == "s":
                    s[p] = rnd.choice("abc")
                elif p + 1 < len(s):
                    s[p], s[p + 1] = s[p + 1], s[p]
            words.add("".join(s))
    words = sorted(words)
    vocab = spark.createDataFrame([(w, i + 1) for i, w in enumerate(words)], "word string, n bigint")
    con = duckdb.connect()
    con.execute("CREATE TABLE v (word VARCHAR, n BIGINT)")
    con.executemany("INSERT INTO v VALUES (?, ?)", [(w, i + 1) for i, w in enumerate(words)])
    # same phonetic key for all (all start with a/b/c and code alike is not guaranteed): compare per Spark key
    keys = {r.word: r.k for r in vocab.selectExpr("word", "soundex(word) AS k").collect()}
    want = {(a, b) for a, b, d in con.execute(
        "SELECT a.word, b.word, damerau_levenshtein(a.word, b.word) FROM v a JOIN v b ON a.n > b.n").fetchall()
        if d < 3 and keys[a] == keys[b]}
    for whole, end in ((6, 2), (8, 3), (10, 4), (12, 3), (50, 24)):  # words much longer than what is indexed whole, a little longer, shorter
        got = {(r.a, r.b) for r in typo_candidates(vocab, whole, end).collect()}
        assert got == want, (whole, end)


def test_words_with_a_long_common_prefix_do_not_meet(spark):
    """10,000 words share 21 characters: a word meets its own typos, not the block."""
    import hashlib
    import time

    from relcast.operators.categories import typo_candidates

    stem = lambda i: "certified registered " + hashlib.md5(str(i).encode()).hexdigest()[:12]
    rows = [(stem(i), 5) for i in range(9000)] + [(stem(i)[:-1], 1) for i in range(500)] + [(stem(i)[:25] + stem(i)[26:], 1) for i in range(500)]
    vocab = spark.createDataFrame(rows, "word string, n bigint")
    start = time.time()
    got = {(r.a, r.b) for r in typo_candidates(vocab).collect()}
    assert got >= {(stem(i), stem(i)[:-1]) for i in range(500)} | {(stem(i), stem(i)[:25] + stem(i)[26:]) for i in range(500)}
    assert len(got) < 1100 and time.time() - start < 60


def test_candidate_search_is_exact_by_windows(spark):
    """Every block indexed by one end, whichever it is; pairs against all pairs."""
    from relcast.operators import categories

    rnd = random.Random(5)
    words = {"", "a", "ab", "abc"}
    for _ in range(40):
        w = "".join(rnd.choice("abc") for _ in range(rnd.choice((5, 6, 7, 8, 14, 30, 56))))
        for _ in range(6):
            s = list(w)
            for _ in range(rnd.randint(0, 3)):
                p = rnd.randrange(len(s))
                op = rnd.choice("dist")
                if op == "d" and len(s) > 1:
                    s.pop(p)
                elif op == "i":
                    s.insert(p, rnd.choice("abc"))
                elif op == "s":
                    s[p] = rnd.choice("abc")
                elif p + 1 < len(s):
                    s[p], s[p + 1] = s[p + 1], s[p]
            words.add("".join(s))
    vocab = spark.createDataFrame([(w, i % 7) for i, w in enumerate(sorted(words))], "word string, n bigint")
    con = duckdb.connect()
    con.execute("CREATE TABLE v (word VARCHAR, n BIGINT, k VARCHAR)")
    con.executemany("INSERT INTO v VALUES (?, ?, ?)", [tuple(r) for r in vocab.selectExpr("word", "n", "soundex(word)").collect()])
    want = set(con.execute("SELECT a.word, b.word FROM v a JOIN v b ON a.n > b.n AND a.k = b.k AND damerau_levenshtein(a.word, b.word) < 3").fetchall())
    assert len(want) > 100
    real = categories.window_blocks
    try:
        for side in ("head", "tail"):
            for window in (3, 5, 7, 10):
                categories.window_blocks = lambda keyed, *_: keyed.select("pkey").distinct().withColumn("side", F.lit(side))  # noqa: B023
                got = [(r.a, r.b) for r in categories.typo_candidates(vocab, window=window).collect()]
                assert len(got) == len(set(got)) and set(got) == want, (side, window)
    finally:
        categories.window_blocks = real


def test_large_blocks_are_indexed_by_the_end_that_tells_words_apart(spark, tmp_folder):
    """A shared start: the last characters. A shared end: the first. Both shared: whole words, as a window would let all meet."""
    import hashlib

    from relcast.functions.text import phonetic_key
    from relcast.operators.categories import index_rows, typo_candidates, window_blocks

    code = lambda i: hashlib.md5(str(i).encode()).hexdigest()[:10]
    words = [f"certified registered {code(i)}" for i in range(3000)] + [f"zzz{code(i)} of the standard catalogue" for i in range(3000)] + [f"number {code(i)} of the standard list" for i in range(3000)]
    keyed = spark.createDataFrame([(w,) for w in words], "word string").withColumn("pkey", phonetic_key("word"))
    sides = {r.pkey: r.side for r in window_blocks(keyed).collect()}
    assert sides[keyed.where("word like 'cert%'").first().pkey] == "tail"
    assert {sides.get(r.pkey) for r in keyed.where("word like 'number%'").select("pkey").distinct().collect()} == {None}
    assert "head" in {sides.get(r.pkey) for r in keyed.where("word like 'zzz%'").select("pkey").distinct().collect()}
    # the first block has 56 rows a word at most, not hundreds; its typos are found
    assert keyed.where("word like 'cert%'").select(index_rows(F.length("word")).alias("r")).first().r == 497
    vocab = keyed.where("word like 'cert%'").select("word", F.lit(2).alias("n"))
    typos = vocab.limit(10).select(F.concat("word", F.lit("x")).alias("word"), F.lit(1).alias("n"))
    typos.write.parquet(f"{tmp_folder}/typos")
    typos = spark.read.parquet(f"{tmp_folder}/typos")
    assert {(r.a, r.b) for r in typo_candidates(vocab.unionByName(typos)).collect()} >= {(r.word[:-1], r.word) for r in typos.collect()}
