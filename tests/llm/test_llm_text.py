"""Decontamination, quality rules, licences, secrets, token counts."""

import random
import textwrap
from collections import Counter
from pathlib import Path

import plain
import pytest
from pyspark.sql import functions as F

from sediment.llm import decontaminate, license_blocks, licenses, quality, secrets, token_counts

VOCABULARY = "alpha beta gamma delta ÉTÉ straße Omega x1 42 the of and in Über q".split()


def texts(seed, n, longest=60):
    """Texts of few words with odd separators, some null, empty or alike."""
    r = random.Random(seed)
    made = ["".join(r.choice(VOCABULARY) + r.choice([" ", " ", "\n", ", ", "\t-"]) for _ in range(r.randrange(longest))) for _ in range(n)]
    return [None, "", " \n ", *made, made[0], made[1]]


@pytest.mark.parametrize("limit", [None, -1])
def test_decontamination_is_that_of_plain_python(spark, frame, monkeypatch, limit):
    if limit is not None:
        monkeypatch.setattr("sediment.operators.lookup.BROADCAST_BYTES", limit)
    found = texts(1, 40)
    items = [(1, " ".join(found[5].split()[:12])), (2, found[6]), (10, "Beta gamma"), (3, None), (4, ""), (None, "the OF"), (2, found[9])]
    docs = [(i // 2 if i % 7 else None, t) for i, t in enumerate(found)]
    docs += [docs[7], docs[7]]
    # Other columns, also of names the operator uses itself, are not read.
    df = frame("doc_id long, text string, w string, p int, gram string", *((*d, "x", 1, "y") for d in docs))
    benchmark = frame("item_id long, text string, len int", *((*i, 1) for i in items))
    got = decontaminate.find_hits(df, benchmark)
    want = plain.contamination(docs, items)
    hits = Counter()
    for r in got.collect():
        hits[r.doc_id, r.n_words, r.n_hit, tuple(r["items"])] += r.copies
    assert hits == Counter((d, n, h, tuple(i)) for d, t in docs for n, h, i in [want[d, t]])
    clean = decontaminate.decontaminate(df, benchmark)
    assert clean.columns == df.columns
    assert Counter((r.doc_id, r.text) for r in clean.collect()) == Counter(d for d in docs if not want[d][1])


def test_decontamination_of_empty_tables(spark, frame):
    docs, none = frame("doc_id long, text string", (1, "a b")), frame("item_id long, text string")
    assert [(r.n_words, r.n_hit, r["items"]) for r in decontaminate.find_hits(docs, none).collect()] == [(2, 0, [])]
    assert decontaminate.find_hits(docs.limit(0), none).count() == 0
    assert decontaminate.decontaminate(docs, none).count() == 1


def test_quality_counts_and_verdicts(spark, frame):
    found = texts(2, 60, 120) + ["*** ### " * 40, "a b c " * 30, "same line\n" * 40]
    rows = [(i, t, ["good", "mixed", None][i % 3]) for i, t in enumerate(found)]
    rows += [(1000 + i, f"tiny {i}", "junk") for i in range(60)]
    df = frame("doc_id long, text string, source string, n_words string, kept string", *((*r, "n", "k") for r in rows))
    got = quality.judge(df)
    kept = plain.kept_by_quality([(t, s) for _, t, s in rows])
    assert plain.bad_hosts([(t, s) for _, t, s in rows]) == {"junk"}
    want = {i: (*plain.quality_counts(t)[:5], k) for (i, t, _), k in zip(rows, kept)}
    assert {r.doc.doc_id: (*(r[c] for c in quality.COUNTS), r.kept) for r in got.collect()} == want
    assert got.select("doc.*").columns == df.columns
    assert quality.judge(df.limit(0)).count() == 0
    assert {r[0] for r in got.where("host_failed").select("doc.source").collect()} == {"junk"}


def test_a_host_with_few_documents_is_pulled_to_the_rest(spark, frame):
    long = " ".join(f"w{i}" for i in range(60))
    rows = [(f"h{h}", long if i % 10 else "short") for h in range(8) for i in range(50)] + [("new", "short")]
    df = frame("host string, text string", *rows)
    counted = quality.judge(df, host="host")
    # Its one document fails by itself, but one failure says little of a host.
    assert not any(r.host_failed for r in counted.collect())


def test_junk_of_a_host_with_much_of_it_goes_and_its_clean_documents_stay(spark, frame):
    clean = " ".join(f"w{i}" for i in range(60))
    rows = [(i, " ".join(f"w{j}$$$" for j in range(60)) if i % 100 < (40 if h == 9 else 3) else clean, f"h{h}") for h in range(10) for i in range(100 * h, 100 * h + 100)]
    # One junk document says little of a host, and one without a host nothing.
    rows += [(2000, rows[0][1], "new"), (2001, rows[0][1], None), (2002, clean, None)]
    got = {r.doc.doc_id: r for r in quality.judge(frame("doc_id long, text string, source string", *rows)).collect()}
    assert not any(r.base_failed or r.host_failed for r in got.values())
    assert {i for i, r in got.items() if not r.kept} == {i for i, r in got.items() if r.rule_failed} == set(range(900, 940))
    # Hosts that are alike lose nothing, however much of it they have.
    alike = [(i, rows[0][1] if i % 5 < 2 else clean, f"h{i % 7}") for i in range(700)]
    assert quality.judge(frame("doc_id long, text string, source string", *alike)).where("kept").count() == 700


def test_licences_by_canonical_digest(spark, frame):
    rows = [
        (1, "licensed under the APACHE licence -- version 2.0"),
        (2, "(c) 2020 Someone\nReleased under the MIT License!"),
        (3, "words\nAll rights reserved.\nmore\nLicensed under CC BY-NC 4.0"),
        (4, "Not licensed under the Apache License, Version 2.0."),
        (5, None), (6, ""), (7, "...\n \n"), (1, "licensed under the APACHE licence -- version 2.0"),
    ]
    df = frame("doc_id long, text string, digest string", *((*r, "d") for r in rows))
    got = sorted(tuple(r) for r in licenses.scan_licenses(df).collect())
    one = (1, "Apache-2.0", "Apache-2.0", 1, True)
    assert got == [
        one, one, (2, "MIT", "MIT", 1, True), (3, "", "CC-BY-NC-4.0,proprietary", 2, True), (4, "", "", 0, False),
        (5, "", "", 0, False), (6, "", "", 0, False), (7, "", "", 0, False),
    ]
    assert licenses.scan_licenses(df.limit(0)).count() == 0


def test_licences_of_several_lines(spark, frame):
    def wrapped(text, width, mark=""):
        return "\n".join(mark + x for x in textwrap.wrap(text, width))

    mit = license_blocks.MIT.format(next="")
    bsd = license_blocks.BSD_2.format(one="* ", two="* ", whose="COPYRIGHT HOLDERS AND CONTRIBUTORS", who="COPYRIGHT OWNER OR CONTRIBUTORS")
    apache = 'Licensed under the Apache License, Version 2.0 (the "License");\n// you may not use this file except in compliance with the License.\n// You may'
    third = "Neither the name of Some Company nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
    gpl = "This file is free software; you can redistribute it and/or modify it under the terms of the GNU General Public Licence as published by the Free Software Foundation; either version 2 of the Licence, or (at your option) any later version."
    rows = [
        *((w, "MIT License\n\nCopyright (c) 2020 Someone\n\n" + wrapped(mit, w)) for w in range(30, 90, 3)),
        (100, "code\n" + wrapped(mit, 60, "# ") + "\nmore code"),
        (101, wrapped(bsd, 75)),
        (102, "/* by me */\n// " + apache),
        (103, wrapped(third, 50, " * ")),
        (104, "x\n" + wrapped(gpl, 40, "-- ")),
        (105, wrapped(mit.replace("free of charge", "for a charge"), 70)),
        (106, wrapped(mit[:-60], 70)),
        (107, wrapped(mit, 70) + "\n\n" + wrapped(bsd, 70) + "\n\n" + wrapped(mit, 50)),
    ]
    got = {r.doc_id: tuple(r)[1:] for r in licenses.scan_licenses(frame("doc_id long, text string", *rows)).collect()}
    assert {got[w] for w in range(30, 90, 3)} == {("MIT", "MIT", 0, True)}
    assert got[100] == ("", "MIT", 0, True) and got[101] == ("BSD-2-Clause", "BSD-2-Clause", 0, True)
    assert got[102] == ("", "Apache-2.0", 0, True) and got[103][1:] == ("BSD-3-Clause", 0, True) and got[104][1:] == ("GPL-2.0", 0, True)
    # Other words, or a part, are not the text.
    assert got[105] == got[106] == ("", "", 0, False)
    assert got[107] == ("", "BSD-2-Clause,MIT", 0, True)


SHARED = Path("/usr/share/common-licenses")


@pytest.mark.skipif(not SHARED.exists(), reason="no licence texts")
def test_full_licence_texts(spark, frame):
    names = {"Apache-2.0": "Apache-2.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-2.1": "LGPL-2.1", "LGPL-3": "LGPL-3.0", "MPL-2.0": "MPL-2.0", "CC0-1.0": "CC0-1.0"}
    texts = {n: (SHARED / n).read_text() for n in names}
    rows = [(n, t) for n, t in texts.items()] + [(f"{n} in one line", " ".join(t.split("\n"))) for n, t in texts.items() if n != "Apache-2.0"]
    rows += [(f"{n} cut", t[: len(t) // 2]) for n, t in texts.items()]
    got = {r.doc_id: r for r in licenses.scan_licenses(frame("doc_id string, text string", *rows)).collect()}
    for n, license in names.items():
        assert license in got[n].line_licenses.split(","), n
        assert license not in got[f"{n} cut"].line_licenses.split(",")


def test_secrets_and_their_owners(spark, frame):
    key, mine = "AKIA" + "Q7ABCDEFGH234567", "AKIA" + "ZZZZZZZZZZ234567"
    live = "Zx9" + "aB3dE5fG7hJ9kL1mN2pQ4rS6tU8v"
    rows = [(i, f"é the key {key} and so on", f"s{i % 4}") for i in range(8)]
    rows += [(20, f'my Token : "{mine}" {live}0', "s1"), (21, None, "s2"), (22, "", None), (23, "secret=token:abcdefg", "s1")]
    rows += [(30 + i, f"copied {live}1", f"s{i}") for i in range(3)]
    rows += [(40, "x" + "0123456789abcdef" * 2 + "!", None), (40, "x" + "0123456789abcdef" * 2 + "!", None)]
    df = frame("doc_id long, text string, source string, owner string, found string", *((*r, "o", "f") for r in rows))
    got = {r.doc_id: (r.copies, [(secrets.KINDS[s.kind], s.start, s.end, s.owners, s.live) for s in r.spans]) for r in secrets.scan_secrets(df).collect()}
    assert got[0] == (1, [("access", 10, 30, 4, False)])
    assert got[20] == (1, [("assign", 3, 32, 1, True), ("access", 12, 32, 1, True), ("opaque", 34, 66, 1, True)])
    assert got[21] == got[22] == (1, [])
    # A match that fails still uses its text up.
    assert got[23] == (1, [])
    # What three owners have is an example; the base kinds stay all the same.
    assert got[30] == got[31] == got[32] == (1, [])
    assert got[40] == (2, [("hex", 1, 33, 1, True)])
    assert secrets.scan_secrets(df.limit(0)).count() == 0


MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def unigram(vocabulary):
    from tokenizers import Tokenizer, models

    pieces = [("<never>", 0.0), *vocabulary.pieces, *((f"<0x{b:02X}>", 0.0) for b in range(256))]
    return Tokenizer(models.Unigram(pieces, unk_id=0, byte_fallback=True))


@pytest.mark.skipif(not Path(MODEL).exists(), reason="no vocabulary")
def test_token_counts_are_the_tokenizers(spark, frame):
    vocabulary = token_counts.Vocabulary.from_sentencepiece(MODEL)
    r = random.Random(5)
    letters = "etaoin shrdluéß\n\t  .,!0123漢字Ж🙂▁"
    found = texts(3, 40) + ["".join(r.choice(letters) for _ in range(r.randrange(200))) for _ in range(150)]
    # The other tokenizer knows byte pieces as texts and gives those the score 0, above the unknown ones.
    lowest = min(s for _, s in vocabulary.pieces)
    other = unigram(token_counts.Vocabulary(tuple((p, s) for p, s in vocabulary.pieces if s > -1e8)))
    mine = token_counts.Vocabulary(tuple((p, s) for p, s in vocabulary.pieces if s > -1e8))
    assert lowest < -1e8
    df = frame("doc_id long, text string, n_tokens string", *((i, t, "n") for i, t in enumerate(found)))
    got = {x.doc_id: x.n_tokens for x in token_counts.count_tokens(df, mine).collect()}
    for i, t in enumerate(found):
        want = len(other.encode("▁" + t.replace(" ", "▁"), add_special_tokens=False).ids) if t else 0
        assert got[i] == want, (t, got[i], want)


def test_equal_scores_go_to_the_match_that_starts_first():
    from tokenizers import Tokenizer, models

    r = random.Random(9)
    for _ in range(200):
        pieces = {"".join(r.choice("abc") for _ in range(r.randrange(1, 5))): -float(r.randrange(4)) for _ in range(8)}
        vocabulary = token_counts.Vocabulary((*pieces.items(), ("▁", -1.0)), dummy_prefix=False)
        other = Tokenizer(models.Unigram([("<never>", -9.0), *vocabulary.pieces, *((f"<0x{b:02X}>", -9.0) for b in range(256))], 0, True))
        lowest = min(s for _, s in vocabulary.pieces)
        counter = token_counts.Counter(vocabulary)
        counter.unknown = -9.0 - token_counts.UNKNOWN_PENALTY
        assert lowest >= -9
        for _ in range(20):
            t = "".join(r.choice("abcd") for _ in range(r.randrange(1, 12)))
            assert counter.count(t) == len(other.encode(t, add_special_tokens=False).ids), (pieces, t)


def test_token_counts_of_nothing(spark, frame):
    df = frame("doc_id long, text string", (1, None), (1, None), (2, ""))
    counted = token_counts.count_tokens(df, token_counts.Vocabulary((("a", -1.0),)))
    assert sorted(tuple(r) for r in counted.collect()) == [(1, 0), (1, 0), (2, 0)]
    assert token_counts.count_tokens(df.limit(0), token_counts.Vocabulary((("a", -1.0),))).count() == 0


def test_a_very_long_text_and_word(spark, frame):
    long, word = "aé " * 200_000, "b" * 300_000
    df = spark.createDataFrame([(1, long, "s"), (2, word, "s")], "doc_id long, text string, source string")
    counts = {r.doc.doc_id: (r.n_words, r.n_repeat_words) for r in quality.judge(df, drop_text=True).collect()}
    assert counts == {1: (200_000, 200_000), 2: (1, 0)}
    hits = decontaminate.find_hits(df, df.select(F.col("doc_id").alias("item_id"), F.lit("aé " * 10).alias("text")).limit(1))
    assert {r.doc_id: r.n_hit for r in hits.collect()} == {1: 200_000, 2: 0}
    vocabulary = token_counts.Vocabulary((("▁", -1.0), ("▁aé", -1.0), ("bb", -1.0), ("b", -1.0)))
    assert {r.doc_id: r.n_tokens for r in token_counts.count_tokens(df, vocabulary).collect()} == {1: 200_001, 2: 150_001}



@pytest.mark.parametrize("limit", [0, 32 << 20])
def test_rows_that_pass_the_quality_rules_are_those_judged_so(spark, frame, monkeypatch, limit):
    """Null ids, texts and hosts, repeated rows, one id with a good and a bad text, one text under several hosts, clashing columns."""
    monkeypatch.setattr("sediment.operators.lookup.BROADCAST_BYTES", limit)
    good, bad = " ".join(f"word{i}" for i in range(80)), "too short"
    texts = [good, bad, None, "", good + " more", "### " * 90 + good]
    rows = [(i, t, h) for i in (None, 1, 2) for t in texts for h in (None, "a", "b")]
    rows += rows[:7]
    df = frame("doc_id long, text string, source string, _d int, _k string, row int, kept boolean", *((*x, n, "k", n, False) for n, x in enumerate(rows)))
    want = {r.doc._d for r in quality.judge(df).where("kept").collect()}
    got = quality.kept_rows(df)
    assert got.columns == df.columns
    found = [r._d for r in got.collect()]
    assert sorted(found) == sorted(want) and 10 < len(want) < len(rows) - 10
    assert quality.kept_rows(df.limit(0)).count() == 0
