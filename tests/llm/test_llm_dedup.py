"""SimHash groups, line dedup, components and mixing."""

import random
from collections import Counter

import plain
import pytest
from pyspark.sql import functions as F

from sediment.llm import components, line_dedup, mixing, simhash
from sediment.llm.batches import BATCH_SIZE
from sediment.staging import Staging


def words(r, n, size=400):
    return [f"w{r.randrange(size)}" for _ in range(n)]


def near_copies(seed, n):
    """Groups of texts with a few words changed, some null or empty, some alike."""
    r = random.Random(seed)
    out = [None, "", " ", "ONE", "one"]
    for _ in range(n):
        base = words(r, r.randrange(1, 120))
        for _ in range(r.randrange(1, 5)):
            copy = list(base)
            for _ in range(r.randrange(3)):
                copy[r.randrange(len(copy))] = "changed"
            out.append(" ".join(copy))
    return out + out[-2:]


def test_fingerprints_are_those_of_plain_python():
    for text in [*near_copies(1, 30), "É Ä " * 9, "a\x0bb\x1cc d e", " ".join(words(random.Random(2), 3000))]:
        assert simhash.fingerprint(text) == plain.fingerprint(text)


def test_a_text_longer_than_a_chunk(monkeypatch):
    text = " ".join(words(random.Random(3), 500))
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "CHUNK", 64)
    assert simhash.fingerprint(text) == whole == plain.fingerprint(text)


@pytest.mark.parametrize("bits", [0, 1, 3, 4, 6])
def test_links_are_all_pairs_within_the_distance(spark, bits):
    r = random.Random(bits)
    prints = {0, (1 << 64) - 1}
    for _ in range(25):
        base = r.getrandbits(64)
        for _ in range(6):
            prints.add(base ^ sum(1 << b for b in r.sample(range(64), r.randrange(8))))
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    df = spark.createDataFrame([(signed(p),) for p in prints], "fp long")
    got = Counter((x.a, x.b) for x in simhash.links(df, bits).collect())
    want = {tuple(sorted((signed(p), signed(q)))) for p in prints for q in prints if p < q and bin(p ^ q).count("1") <= bits}
    assert set(got) == want and all(n == 1 for n in got.values())


def test_groups_and_what_stays(spark, frame):
    found = near_copies(4, 40)
    ids = list(range(len(found)))
    random.Random(1).shuffle(ids)
    docs = [*zip(ids, found), (None, found[7]), (None, "alone " * 5), (None, "alone " * 5), (ids[9], found[9]), (ids[9], "other text " * 20)]
    df = frame("doc_id long, text string, fp string, root int, _row string", *((*d, "f", 1, "r") for d in docs))
    root = plain.components([plain.fingerprint(t) for _, t in docs])
    group = [root[plain.fingerprint(t)] for _, t in docs]
    low = {}
    for (d, _), g in zip(docs, group):
        if d is not None:
            low[g] = min(low.get(g, d), d)
    got = simhash.near_duplicates(df)
    want = Counter((d, plain.fingerprint(t), low.get(g)) for (d, t), g in zip(docs, group))
    assert Counter((r.doc_id, r.fp % (1 << 64), r.component_id) for r in got.collect()) == want
    kept = simhash.one_of_each(df)
    assert kept.columns == df.columns
    rows = kept.collect()
    assert sorted((r.doc_id is None, r.doc_id) for r in rows) == sorted((low.get(g) is None, low.get(g)) for g in set(group))
    assert len({root[plain.fingerprint(r.text)] for r in rows}) == len(rows)
    none = df.limit(0)
    assert simhash.near_duplicates(none).count() == simhash.one_of_each(none).count() == 0


def test_long_chains_are_one_component(spark):
    n = 300
    chain = spark.range(n).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    star = spark.range(50).select((F.col("id") + 2000).alias("a"), F.lit(1999).cast("long").alias("b"))
    edges = chain.unionByName(star).unionByName(spark.createDataFrame([(5, 5), (7, 6)], "a long, b long"))
    found = components.connected_components(edges, Staging(spark), "c")
    assert {(r.node, r.root) for r in found.collect()} == {*((i, 0) for i in range(n + 1)), *((i, 1999) for i in range(1999, 2050))}
    assert found.count() == n + 1 + 51


def lined(seed, n):
    """Documents whose lines are copied from each other with changes."""
    r = random.Random(seed)
    pool, docs = [], [None, "", "\n\n", "a\na\nA \n b\nb"]
    for _ in range(n):
        lines = []
        for _ in range(r.randrange(1, 8)):
            if pool and r.random() < 0.6:
                w = list(r.choice(pool))
                for _ in range(r.choice([0, 0, 1, 1, 2])):
                    at = r.randrange(len(w) + 1)
                    w[at : at + r.randrange(2)] = ["new" + str(r.randrange(50))] * r.randrange(2)
            else:
                w = words(r, r.choice([1, 2, 4, 5, 6, 9, 20, 40, 60]), 60)
            pool.append(w)
            lines.append(r.choice([" ", "  ", "\t"]).join(w).replace("w1", "W1") if w else "")
        docs.append("\n".join(lines))
    return docs


@pytest.mark.parametrize("limit", [None, -1])
def test_lines_like_earlier_ones_go(spark, frame, monkeypatch, limit):
    if limit is not None:
        monkeypatch.setattr("sediment.operators.lookup.BROADCAST_BYTES", limit)
        monkeypatch.setattr(line_dedup, "CHUNK", 100)
        monkeypatch.setattr(line_dedup, "REMEMBERED", 3)
    docs = list(enumerate(lined(6, 60)))
    want = plain.without_repeated_lines(docs)
    df = frame("doc_id long, text string, row string, gone int, k1 string", *((*d, "r", 1, "k") for d in reversed(docs)))
    got = line_dedup.dedup_lines(df.repartition(5))
    assert {r.row.doc_id: r.text for r in got.collect()} == dict(enumerate(want))
    for r in got.collect():
        lines, left = (0 if t is None else len(t.split("\n")) for t in (r.row.text, r.text))
        # A text without lines and one with an empty line look alike.
        assert r.n_lines == lines and r.n_removed in (lines - left, lines if r.text == "" else None)
    assert got.select("row.*").columns == df.columns


def test_lines_are_compared_word_by_word(spark, frame):
    """One of twenty words differs, two long words differ, and patterns that collide in polynomials of any base."""
    base = [f"w{i}" for i in range(20)]
    a, b = "a", "b"
    for _ in range(10):
        a, b = a + b, b + a
    pattern, other = " ".join("x" if c == "a" else "y" for c in a * 4), " ".join("x" if c == "b" else "y" for c in a * 4)
    docs = [(1, " ".join(base)), (2, " ".join(base[:9] + ["new"] + base[10:])), (3, a), (4, b), (5, pattern), (6, other), (7, "m n o p"), (8, "p o n m"), (9, "m n o")]
    got = {r.row.doc_id: r.n_removed for r in line_dedup.dedup_lines(frame("doc_id long, text string", *docs)).collect()}
    # The two patterns are different lines of the same two words.
    assert got == {1: 0, 2: 1, 3: 0, 4: 0, 5: 0, 6: 1, 7: 0, 8: 1, 9: 0}


def test_a_very_long_line_and_ids_of_any_type(spark, frame):
    long = " ".join(f"v{i}" for i in range(30_000))
    docs = [("b", long), ("a", long + " one more"), (None, "x" * 200_000 + "\n" + long)]
    got = {r.row.doc_id: r.n_removed for r in line_dedup.dedup_lines(frame("doc_id string, text string", *docs)).collect()}
    assert got == {"a": 0, "b": 1, None: 1}


def test_rows_alike_lose_the_same_lines(spark, frame):
    text = "one two three four five six\nother words in here too yes\none two three four five six"
    df = frame("doc_id long, text string", (5, text), (5, text), (None, text), (None, "alone here"))
    kept = "one two three four five six\nother words in here too yes"
    found = Counter((r.row.doc_id, r.text) for r in line_dedup.dedup_lines(df).collect())
    assert found == {(5, kept): 2, (None, ""): 1, (None, "alone here"): 1}
    assert line_dedup.dedup_lines(df.limit(0)).count() == 0


def test_token_order_is_the_same_either_way():
    import numpy as np

    r = np.random.default_rng(1)
    rarity = line_dedup.levels(r.integers(0, 10**6, 1 << 18))
    found = r.integers(0, 1 << 63, 5000, dtype=np.uint64) * np.uint64(2)
    where = np.sort(r.integers(0, 40, 5000))
    fast = line_dedup.rarest_first(found, where, rarity, 18)
    slow = np.lexsort((found, rarity[(found >> np.uint64(46)).astype(np.int64)], where))
    assert (found[fast] == found[slow]).all() and (where[fast] == where[slow]).all()
    # Hashes that differ in their last bits only.
    close = np.array([8, 9, 7, 8], np.uint64)
    assert close[line_dedup.rarest_first(close, np.zeros(4, np.int64), rarity, 18)].tolist() == [7, 8, 8, 9]


def mixing_rows(seed, n):
    r = random.Random(seed)
    sources = [None, "a", "b", "é", "z" * 3, "empty"]
    rows = [(r.choice([None, i]) if i % 9 == 0 else i, " ".join(words(r, r.randrange(0, 30))), r.choices(sources[:5], [1, 30, 3, 2, 1])[0]) for i in range(n)]
    return rows + [(900, None, "empty"), (901, "", "empty"), rows[3], rows[3], rows[3]]


@pytest.mark.parametrize("bucket", [4_000, 5])
def test_mixing_is_that_of_plain_python(spark, frame, monkeypatch, bucket):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", bucket)
    rows = mixing_rows(8, 300)
    df = frame("doc_id long, text string, source string, key string, size int", *((*r, "k", 1) for r in rows))
    got = Counter(tuple(r) for r in mixing.mix(df.repartition(3)).collect())
    want = Counter(plain.mixed(rows))
    # Rows alike in id and size may swap what they take, but not what all of them take.
    total = lambda c: {k: sum(x[4] * n for x, n in c.items() if x[0] == k) for k in {x[0] for x in c}}
    assert total(got) == total(want) and sum(got.values()) == len(rows)
    short = lambda c: Counter({(x[:3], round(x[3], 6)): 0 for x in c})
    assert set(short(got)) == set(short(want))
    sums, target = Counter(), {}
    for (_, size, whole, goal, taken), n in got.items():
        assert taken <= 3 * size and (size == 0 or taken % size == 0)
        sums[whole, goal] += taken * n
        target[whole, goal] = goal
    assert all(abs(sums[k] - target[k]) <= 60 for k in sums)


def test_mixing_of_nothing(spark, frame):
    df = frame("doc_id long, text string, source string", (1, "", "a"), (2, None, None))
    assert sorted(tuple(r) for r in mixing.mix(df).collect()) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]
    assert mixing.mix(df.limit(0)).count() == 0


def test_long_lines_that_are_similar_pass_both_halves_of_their_bitmaps(spark):
    """Lines around WIDE words and far beyond, with as many words changed as the threshold allows and more: none that is similar is lost."""
    r = random.Random(8)
    lines = []
    for n in (60, 79, 80, 81, 90, 100, 101, 150, 400, 1500):
        base = [f"w{r.randrange(10**9)}" for _ in range(n)]
        lines.append(base)
        for changed in (n // 9 - 1, n // 9, n // 9 + 1, n // 4):
            copy = list(base)
            for i in r.sample(range(n), changed):
                copy[i] = f"x{r.randrange(10**9)}"
            lines.append(copy)
        lines.append(base[: -(n // 5)])
        lines.append([*base[: n // 2], *(f"y{r.randrange(10**9)}" for _ in range(n // 2))])
    order = list(range(len(lines)))
    r.shuffle(order)
    lines = [lines[i] for i in order]
    df = spark.createDataFrame([(i, " ".join(line)) for i, line in enumerate(lines)], "doc_id long, text string")
    sets = [set(line) for line in lines]
    want = {i for i, s in enumerate(sets) if any(5 * len(s & t) >= 4 * len(s | t) for t in sets[:i])}
    assert 15 < len(want) < len(lines) - 15
    got = line_dedup.dedup_lines(df).where("n_removed > 0").select("row.doc_id").collect()
    assert {x.doc_id for x in got} == want


@pytest.mark.parametrize("given, within", [("10000", 500), ("0", 500), ("7", 7)])
def test_whole_texts_go_to_workers_in_small_batches(spark, staging, monkeypatch, given, within):
    before, seen, sketch = spark.conf.get(BATCH_SIZE), [], line_dedup.sketch

    def sizes(batches):
        for batch in batches:
            yield batch.from_arrays([[batch.num_rows]], names=["n"])

    def spied(texts):
        seen.append(max(r.n for r in texts.mapInArrow(sizes, "n long").collect()))
        return sketch(texts)

    monkeypatch.setattr(line_dedup, "sketch", spied)
    docs = spark.range(0, 1200, 1, 1).select(F.col("id").alias("doc_id"), F.concat(F.lit("line "), F.col("id") % 900).alias("text"))
    spark.conf.set(BATCH_SIZE, given)
    try:
        gone = line_dedup.removed_lines(docs, staging)
        assert gone.count() == 300 and seen == [within]
        assert spark.conf.get(BATCH_SIZE) == given
    finally:
        spark.conf.set(BATCH_SIZE, before)


def copies_of_few(seed, n, changed, size=60):
    """Lines that are copies of three base lines with so many words changed; no base line comes first."""
    r = random.Random(seed)
    bases = [[f"b{j}x{i}" for i in range(size)] for j in range(3)]
    out = []
    for i in range(n):
        line = list(bases[i % 3])
        for at in r.sample(range(size), r.randrange(changed + 1) if i > 9 else changed):
            line[at] = f"n{r.randrange(10**9)}"
        out.append(" ".join(line))
    return out


def test_few_pairs_of_near_copies_are_compared(spark, staging, monkeypatch):
    """Two copies are similar or not by chance, so the earliest of each group settles only some of the others."""
    compared, matched = [], line_dedup._matched
    monkeypatch.setattr(line_dedup, "_matched", lambda pairs, *rest: compared.append(pairs.count()) or matched(pairs, *rest))
    n = 900
    docs = list(enumerate(copies_of_few(11, n, 4)))
    gone = line_dedup.removed_lines(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), staging)
    want = [i for i, t in enumerate(plain.without_repeated_lines(docs)) if not t]
    assert sorted(r.doc_id for r in gone.collect()) == want and len(want) > n // 2
    assert sum(compared) < 20 * n


@pytest.mark.parametrize("parts", [1, 2])
def test_the_earlier_line_is_found_whatever_the_rows_order(spark, frame, monkeypatch, parts):
    """Rows come last id first, ids repeat with other texts or are null, so lines are first read where they are not earliest."""
    monkeypatch.setattr(line_dedup, "PARTS", parts)
    r = random.Random(12)
    pool = copies_of_few(13, 60, 8) + copies_of_few(14, 30, 2, 9) + ["one", "one two", "two one"]
    docs = [(r.choice([None, i // 4, i // 4 + 1, 7]), "\n".join(r.choices(pool, k=r.randrange(1, 4)))) for i in range(90, 0, -1)]
    df = frame("doc_id long, text string", *docs).coalesce(1)
    keys = {x.text: x.k for x in df.select("text", line_dedup.text_key(F.col("text")).alias("k")).collect()}
    lines = sorted({(d is None, d or 0, keys[t], no, line) for d, t in docs for no, line in enumerate(t.split("\n"))})
    sets = [plain.line_words(x[4]) for x in lines]
    want = {x[:4] for i, x in enumerate(lines) if any(5 * len(sets[i] & s) >= 4 * len(sets[i] | s) for s in sets[:i])}
    gone = line_dedup.removed_lines(df, Staging(spark)).collect()
    assert {(x.doc_id is None, x.doc_id or 0, x.text_key, no) for x in gone for no in x.gone} == want
    assert 20 < len(want) < len(lines)


def test_ids_that_python_cannot_order_are_told_to_be_the_same_only():
    found = [line_dedup.not_before(a, b) for a, b in ((1, 1), (2, 1), (1, 2), (None, 1), (1, None), (None, None), ({"a": 1}, {"a": 1}), ({"a": 2}, {"a": 1}))]
    assert found == [True, True, False, True, False, True, True, False]
    assert not line_dedup.not_before(float("nan"), 1.0)
