"""Pieces, alignment and phrases against the libraries and plain Python."""

import hashlib
import random
import re
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from sediment.llm import alignment, phrases, pieces, queries

FOLDER = "/root/testdata/sf0.001"
MODEL, VOCABULARY = f"{queries.TOKENIZERS}/piece_bpe_32k.model", f"{queries.TOKENIZERS}/byte_bpe_50k.json"
given = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no given tables")
files = pytest.mark.skipif(not Path(MODEL).exists(), reason="no vocabulary files")

ODD = ["", " ", "  ", "x ", " x", "a  b", "\ta\n\n b ", "▁", "a▁b", "<s> </s> <unk>", "<|endoftext|> x", "<0x0A>", "\0 a\0", "é日本語😀", "it's", "a\x1c b", "a b c", "ab" * 4000, "日本語" * 900, " " * 100 + "x", "x" + " " * 37 + "\n" * 5 + "y"]


def odd_texts(seed, n):
    r = random.Random(seed)
    letters = " ▁\n\tab<s>0xé日\0😀.  \x1c'slL—"
    return ["".join(r.choice(letters) for _ in range(r.randrange(0, 30))) for _ in range(n)]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def other():
    import tokenizers

    found = tokenizers.Tokenizer.from_file(VOCABULARY)
    found.encode_special_tokens = True
    return found


def given_texts(spark, folder=FOLDER):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]


@files
@given
def test_pieces_query_equals_the_library(spark, library):
    want = Counter()
    for d, t in given_texts(spark):
        ids = library.encode(t or "")
        want[d, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids))] += 1
    assert Counter(tuple(r) for r in queries.op11_sentencepiece(spark, FOLDER).collect()) == want


@files
def test_pieces_of_odd_texts(spark, library):
    texts = [None, *ODD, *odd_texts(1, 400), *ODD]
    df = spark.createDataFrame([(i % 7 if i % 5 else None, t, "r", [i]) for i, t in enumerate(texts)], "ids long, text string, row string, batch array<int>")
    model = pieces.read_model(MODEL)
    encoded = pieces.encode_texts(df, model)
    got = Counter((r.row.ids, r.row.text, tuple(r.row.batch), tuple(r.ids)) for r in encoded.collect())
    assert got == Counter((i % 7 if i % 5 else None, t, (i,), tuple(library.encode(t or ""))) for i, t in enumerate(texts))
    both = pieces.encode_texts(df, model, keep=["row", "ids"], decode=True)
    assert {r.row.ids for r in both.collect()} == {*range(7), None} and both.columns == ["row", "ids", "decoded"]
    assert all(r.decoded == library.decode(list(r.ids)) for r in both.collect())
    decoded = pieces.decode_ids(encoded.select("ids", F.col("row.text").alias("text")), model)
    assert all(r.text == library.decode(list(r.row.ids)) for r in decoded.collect())
    # What both directions keep, all but a mark in the text.
    assert all(r.text == (r.row.text or "") for r in decoded.collect() if "▁" not in (r.row.text or ""))
    assert pieces.encode_texts(df.limit(0), model).count() == pieces.decode_ids(encoded.limit(0), model).count() == 0
    none = spark.createDataFrame([(None,), ([],), ([3, 1, 2, 0, 5, 300],)], "ids array<int>")
    assert [r.text for r in pieces.decode_ids(none, model).collect()] == ["", "", library.decode([3, 1, 2, 0, 5, 300])]


@files
def test_bytes_that_are_no_text_become_marks_of_replacement(spark, library):
    df = spark.sql("select cast(x'61FF62' as string) as text")
    assert list(pieces.encode_texts(df.select("text"), pieces.read_model(MODEL)).first().ids) == library.encode("a�b")


@files
def test_table_of_words_may_be_begun_anew(library, monkeypatch):
    monkeypatch.setattr(pieces, "TABLE_WORDS", 3)
    encoder = pieces.Encoder(pieces.read_model(MODEL))
    for t in [*ODD, *odd_texts(2, 50)]:
        assert encoder.encode([t, "again " + t])[0].tolist() == library.encode(t) + library.encode("again " + t)


@files
def test_models_with_pieces_over_marks_take_whole_texts(library):
    proto = pieces.parsed(pieces.read_model(MODEL))
    assert pieces.splits_at_marks(proto)
    proto.pieces[500].piece = "a▁b"
    assert not pieces.splits_at_marks(proto)
    encoder = pieces.Encoder(pieces.read_model(MODEL))
    encoder.by_word = False
    assert encoder.encode(["a b", "", " c"])[0].tolist() == library.encode("a b") + library.encode(" c")


@files
def test_decoding_any_ids(library):
    decoder, r = pieces.Decoder(pieces.read_model(MODEL)), random.Random(3)
    for _ in range(2000):
        ids = [r.randrange(32000) if r.random() < 0.5 else r.randrange(260) for _ in range(r.randrange(0, 9))]
        assert decoder.decode(np.array(ids, np.int32), np.array([len(ids)])) == [library.decode(ids)]
    with pytest.raises(ValueError, match="outside"):
        decoder.decode(np.array([40000]), np.array([1]))


def plain_groups(text, aligner):
    """Tokens of both and their groups, by the common ends of all tokens."""
    if not text:
        return [], [], []
    a, b = aligner.a.encode(" " + text, add_special_tokens=False).ids, aligner.b.encode(text)
    if not b"".join(aligner.bytes_a[i] for i in a) == (" " + text).encode() == b"".join(aligner.bytes_b[i] for i in b):
        return [], [], []
    ends = [np.cumsum([len(t[i]) for i in ids]).tolist() for t, ids in ((aligner.bytes_a, a), (aligner.bytes_b, b))]
    out, i, j = [], 0, 0
    for cut in sorted(set(ends[0]) & set(ends[1])):
        k, m = ends[0].index(cut) + 1, ends[1].index(cut) + 1
        out.append((a[i:k], b[j:m]))
        i, j = k, m
    return a, b, out


def plain_alignment(texts, aligner):
    found = [plain_groups(t, aligner) for t in texts]
    links = [Counter((x, y) for u, v in g for x in u for y in v) for _, _, g in found]
    held = Counter(p for c in links for p in c)
    best = {}
    for (x, _), n in held.items():
        best[x] = max(best.get(x, 0), n)
    out = []
    for (a, b, g), c in zip(found, links):
        shown = ";".join(",".join(map(str, u)) + "|" + ",".join(map(str, v)) for u, v in g)
        n_best = sum(n for p, n in c.items() if held[p] == best[p[0]])
        out.append((len(a), len(b), len(g), sum(c.values()), n_best, sum(n * held[p] for p, n in c.items()), sha(shown) if shown else ""))
    return out


@files
@given
def test_alignment_query_equals_plain(spark):
    docs = given_texts(spark)
    aligner = alignment.Aligner(pieces.read_model(VOCABULARY), pieces.read_model(MODEL))
    want = Counter((d, *x) for (d, _), x in zip(docs, plain_alignment([t for _, t in docs], aligner)))
    assert Counter(tuple(r) for r in queries.op13_alignment(spark, FOLDER).collect()) == want


@files
@pytest.mark.parametrize("most", [0, 40, 1 << 20])
def test_alignment_of_odd_texts(spark, most):
    texts = [None, *ODD, *odd_texts(4, 300), *ODD[:6], "same words again", "same words again"]
    df = spark.createDataFrame([(i % 9 if i % 4 else None, t, i, "p") for i, t in enumerate(texts)], "doc_id long, text string, row int, pairs string")
    aligner = alignment.Aligner(pieces.read_model(VOCABULARY), pieces.read_model(MODEL))
    found = alignment.align_corpus(df, VOCABULARY, MODEL, ["row", "doc_id", "pairs"], most=most)
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    got = {r.row.row: tuple(r[n] for n in names) for r in found.collect()}
    assert got == dict(enumerate(plain_alignment(texts, aligner)))
    assert alignment.align_corpus(df.limit(0), VOCABULARY, MODEL, ["doc_id"], most=most).count() == 0


@files
def test_alignment_keeps_its_interface(spark):
    df = spark.createDataFrame([(1, "naïve cafés, 日本"), (2, "a▁b"), (3, None)], "n_a long, text string")
    got = {r.row.n_a: r for r in alignment.align_texts(df, pieces.read_model(VOCABULARY), pieces.read_model(MODEL)).collect()}
    assert got[1].groups.count(";") + 1 == got[1].n_groups and sum(got[1].times) == got[1].n_links and len(set(got[1].pairs)) == len(got[1].pairs)
    assert got[2].n_a == got[3].n_a == 0 and got[2].groups == got[3].groups == "" and not got[2].pairs


def test_a_group_with_many_links_is_counted_by_distinct_ids(monkeypatch):
    r = random.Random(5)
    aligner = alignment.Aligner.__new__(alignment.Aligner)
    aligner.bytes_b = [b""] * 10
    leaves = np.array([[0, 40, 0, 30], [40, 41, 30, 31]])
    ids_a, ids_b = np.array([r.randrange(4) for _ in range(41)]), np.array([r.randrange(3) for _ in range(31)])
    found = []
    for wide in (1 << 12, 8):
        monkeypatch.setattr(alignment, "WIDE", wide)
        aligner._clear()
        aligner._link(ids_a, ids_b, leaves, np.array([1200, 1]), np.array([0, 1]), 2)
        each = Counter()
        for p, n in zip(aligner.pairs, aligner.times):
            each[p] += n
        found.append((each, len(aligner.pairs)))
    assert found[0][0] == found[1][0] and found[1][1] < 20 < found[0][1]


def test_groups_by_halving_are_those_of_all_common_ends():
    r = random.Random(6)
    for _ in range(300):
        size = r.randrange(1, 80)
        ends = [sorted({*(r.randrange(1, size + 1) for _ in range(r.randrange(0, 50))), size}) for _ in range(2)]
        both = sorted(set(ends[0]) & set(ends[1]))
        want, i, j = [], 0, 0
        for e in both:
            k, m = ends[0].index(e) + 1, ends[1].index(e) + 1
            want.append([i, k, j, m])
            i, j = k, m
        a, b = (np.array(e) for e in ends)
        assert alignment.leaf_groups(a, b, np.array([0, len(a)]), np.array([0, len(b)])).tolist() == want


def plain_collocations(docs, params):
    f, total = Counter(), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        text = (text or "").translate({ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
        for piece in re.split("[.,;:!?\n-\r]", text):
            w = [x for x in re.split("[ \t]+", piece) if x]
            total[lang] += len(w)
            for n in range(1, params.longest + 1):
                f.update((lang, *w[i : i + n]) for i in range(len(w) - n + 1))
    found = {p: n for p, n in f.items() if len(p) > 2 and n >= params.least}
    around = Counter()
    for (lang, *w), n in found.items():
        for size in range(2, len(w)):
            for i in range(len(w) - size + 1):
                inner = (lang, *w[i : i + size])
                around[inner] = max(around[inner], n)
    out = {}
    for (lang, *w), a in found.items():
        if 100 * around[(lang, *w)] >= params.covered_percent * a:
            continue
        cuts = [(10**6 * a * a // (f[(lang, *w[:k])] * f[(lang, *w[k:])]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), f[(lang, *w[:k])], f[(lang, *w[k:])]))
    rows = set()
    for lang, each in out.items():
        for i, (score, a, phrase, left, right) in enumerate(sorted(each)[: params.best]):
            rows.add((lang, i + 1, phrase.decode(), -a, left, right, total[lang], -score))
    return rows


def phrase_documents(seed):
    r = random.Random(seed)
    word = lambda: r.choice(["a", "B", "b", "New", "york", "city", "é", "日本", "x\0y", "of", "the", f"w{r.randrange(40)}"])
    gap = lambda: r.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", " \x0b", "new york city "])
    docs = [(r.choice(["en", "de", None, ""]), "".join(word() + gap() for _ in range(r.randrange(0, 60)))) for _ in range(120)]
    return docs + [("en", None), (None, ""), ("en", "..."), ("fr", "the the the the the the the the the the the the"), ("en", "of the " * 3000)] + [docs[0]] * 12


@pytest.mark.parametrize(("longest", "least", "best"), [(3, 10, 2000), (4, 3, 7), (2, 2, 5)])
def test_collocations_equal_plain(spark, longest, least, best, monkeypatch):
    docs = phrase_documents(longest)
    df = spark.createDataFrame([(t, g, 1, "p") for g, t in docs], "text string, lang string, n long, phrase string").repartition(3)
    params = phrases.PhraseParams(longest=longest, least=least, best=best)
    got = phrases.collocations(df, params=params)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    found = [tuple(r) for r in got.collect()]
    assert len(found) == len(set(found)) > 3 and set(found) == plain_collocations(docs, params)


def test_collocations_without_rows(spark):
    none = spark.createDataFrame([], "text string, lang string")
    assert phrases.collocations(none).count() == 0
    empty = spark.createDataFrame([(None, None), ("", "en")], "text string, lang string")
    assert phrases.collocations(empty).count() == 0


def test_a_full_bitmap_and_collisions_change_no_count(spark):
    docs = phrase_documents(9)
    df = spark.createDataFrame([(t, g) for g, t in docs], "text string, lang string")
    params = phrases.PhraseParams(least=4)
    small = phrases.PhraseParams(least=4, bitmap_log2=6)
    assert {tuple(r) for r in phrases.collocations(df, params=small).collect()} == plain_collocations(docs, params)
    block = phrases.Block()
    hasher = phrases.Prefixes(np.uint64(0xA0761D6478BD642F))
    block.add(hasher, [b"x y, x y. z w", b"x y"], ["en", "de"], True)
    block.closed(hasher)
    at, found = block.fingerprints(2)
    first, n = phrases.distinct_phrases(block, at, np.zeros_like(found), 2)
    assert sorted(zip(block.cut(first, 2), n.tolist())) == [("x y", 1), ("x y", 2), ("z w", 1)]


def test_long_texts_are_cut_at_ends_of_pieces(monkeypatch):
    monkeypatch.setattr(phrases, "CHUNK", 10)
    text = b"aaa bbb ccc, ddd eee fff. ggg " + b"h" * 50 + b" iii; jjj kkk"
    parts = list(phrases.segments(text))
    assert b"".join(parts) == text and len(parts) > 2 and all(p[-1:] in b".,;" for p in parts[:-1])
    assert list(phrases.segments(b"")) == [b""]


def test_phrases_travel_in_few_rows_and_are_summed_over_blocks(spark, monkeypatch):
    docs = phrase_documents(5)
    df = spark.createDataFrame([(t, g) for g, t in docs], "text string, lang string").repartition(2)
    params = phrases.PhraseParams(least=4)
    whole = df.where("text is not null").fillna("und", ["lang"])
    found = phrases.fingerprint_counts(whole, (1, 2), None, params.least).collect()
    # A row has many fingerprints where a block has more than parts, and each is in one row of a block.
    assert all(len(r["prints"]) == 8 * len(r["counts"]) for r in found)
    monkeypatch.setattr(phrases, "PARTS_LOG2", 1)
    few = phrases.fingerprint_counts(whole, (1, 2), None, params.least).collect()
    assert len(few) <= 4 and sum(len(r["counts"]) for r in few) == sum(len(r["counts"]) for r in found) > 3 * len(few)
    # Blocks and what is gathered of them are cut anywhere.
    for chunk, block, gathered in ((1, 1, 0), (40, 20, 30), (200, 100, 1 << 20)):
        monkeypatch.setattr(phrases, "CHUNK", chunk)
        monkeypatch.setattr(phrases, "BLOCK_WORDS", block)
        monkeypatch.setattr(phrases, "GATHERED", gathered)
        assert {tuple(r) for r in phrases.collocations(df, params=params).collect()} == plain_collocations(docs, params)


def test_texts_that_share_a_fingerprint_are_told_apart():
    words = [b"ab", b"ac", b"ab", b"abc", b"z"]
    prints, counts = np.array([7, 7, 7, 7, 9], np.uint64), np.array([1, 2, 4, 8, 16], np.uint32)
    texts, lengths = np.frombuffer(b"".join(words), np.uint8), np.array([len(w) for w in words], np.uint32)
    entry, n = phrases.summed_texts(prints, counts, lengths, texts)
    assert sorted(zip((words[i] for i in entry), n.tolist())) == [(b"ab", 5), (b"abc", 8), (b"ac", 2), (b"z", 16)]
    entry, n = phrases.summed_texts(prints[[0, 2, 4]], counts[[0, 2, 4]], lengths[[0, 2, 4]], np.frombuffer(b"ababz", np.uint8))
    assert sorted(n.tolist()) == [5, 16]
