"""Registered queries against their SQL or plain Python, and the pipeline against its stages in plain Python."""

import hashlib
import os
import random
import re
import subprocess
import sys
from collections import Counter
from pathlib import Path

import duckdb
import plain
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from compare import normalized
from sediment.llm import queries, sql

FOLDER = "/root/testdata/sf0.001"

given = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no given tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for f in Path(FOLDER).glob("*.parquet"):
        connection.execute(f"create view {f.stem} as select * from '{f}'")
    return connection


@given
@pytest.mark.parametrize("name", list(sql.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    got = normalized(entry.queries()[name](spark, FOLDER).toPandas())
    want = normalized(duck.execute(entry.oracle_sql()[name]).df())
    assert list(got.columns) == list(want.columns) and len(got) == len(want) > 0
    assert got.equals(want)


def test_every_query_is_registered():
    assert set(queries.queries()) | {"pipeline"} <= set(entry.queries())
    assert [int(re.match(r"op(\d+)_", n)[1]) for n in queries.queries()] == list(range(1, 14))


@given
def test_simhash_query(spark, duck):
    docs = duck.execute("select doc_id, text from documents").fetchall()
    root = plain.components([plain.fingerprint(t) for _, t in docs])
    low = {}
    for d, t in docs:
        g = root[plain.fingerprint(t)]
        low[g] = min(low.get(g, d), d)
    want = Counter((d, f"{plain.fingerprint(t):016x}", low[root[plain.fingerprint(t)]]) for d, t in docs)
    assert Counter(tuple(r) for r in queries.op6_simhash(spark, FOLDER).collect()) == want


@given
def test_secret_query(spark, duck):
    assign = re.compile(r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']? *[:=] *["']?([A-Za-z0-9+/_.=-]+)""")
    got = {r.doc_id: r for r in queries.op7_secret_scan(spark, FOLDER).collect()}
    docs = duck.execute("select doc_id, text from documents").fetchall()
    assert len(got) == len(docs)
    for d, t in docs:
        t = t or ""
        found = [(m.start(), 0, m.end()) for m in assign.finditer(t) if len(m[1]) >= 6]
        found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
        found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
        base = ",".join(f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in sorted(found))
        kinds = Counter(k for _, k, _ in found)
        assert (got[d].n_assign, got[d].n_access, got[d].n_hex) == (kinds[0], kinds[1], kinds[2])
        assert got[d].base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert set(filter(None, base.split(","))) <= set(got[d].spans.split(","))


@given
def test_other_queries_give_a_row_each(spark, duck):
    documents, pages = (duck.execute(f"select count(*) from {t}").fetchall()[0][0] for t in ("documents", "pages"))
    assert queries.op9_token_counts(spark, FOLDER).count() == queries.op5_toxicity(spark, FOLDER).count() == documents
    assert queries.op3_html_extraction(spark, FOLDER).where("n_chars > 0").count() == pages


def corpus(seed):
    """Documents with every fault the stages look for, and a benchmark."""
    r = random.Random(seed)
    word = lambda: f"w{r.randrange(3000)}"
    line = lambda n: " ".join(word() for _ in range(n))
    shared = [line(60) for _ in range(4)]
    items = [(i, line(25)) for i in range(6)]
    docs = []
    for i in range(70):
        lines = [line(r.randrange(20, 60)) for _ in range(r.randrange(1, 5))]
        if r.random() < 0.3:
            lines.insert(r.randrange(len(lines) + 1), r.choice(shared))
        if r.random() < 0.2:
            lines[-1] += " " + r.choice(items)[1]
        docs.append((3 * i, "\n".join(lines), f"src{r.randrange(4)}"))
    docs += [(1000 + i, t.replace(" ", "  ", 3), s) for i, (_, t, s) in enumerate(docs[:10])]
    docs += [(2000, None, "src1"), (2001, "", None), (2002, "too short", "src2"), (2003, "again and again " * 40, "src1")]
    docs += [(3000 + i, f"junk {i}", "bad") for i in range(40)] + [(3999, line(80), "bad")]
    return docs, items


def plain_pipeline(docs, items):
    docs = [d for d, k in zip(docs, plain.kept_by_quality([(t, s) for _, t, s in docs])) if k]
    docs = [(d, t, s) for (d, _, s), t in zip(docs, plain.without_repeated_lines([(d, t) for d, t, _ in docs]))]
    root = plain.components([plain.fingerprint(t) for _, t, _ in docs])
    first = {}
    for d, t, _ in docs:
        first.setdefault(root[plain.fingerprint(t)], d)
    docs = [x for x in docs if x[0] in first.values()]
    hits = plain.contamination([(d, t) for d, t, _ in docs], items)
    return plain.mixed([(d, t, s) for d, t, s in docs if not hits[d, t][1]])


def test_pipeline_is_its_stages_in_plain_python(spark, tmp_path):
    docs, items = corpus(3)
    rows = [(d, t, "en", s, len(t or "")) for d, t, s in docs]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = sorted(tuple(r) for r in corpus_pipeline.run(spark, str(tmp_path)).collect())
    want = sorted(plain_pipeline(docs, items))
    assert 20 < len(want) < 70
    assert [(g[0], g[1], g[2], round(g[3], 6), g[4]) for g in got] == [(w[0], w[1], w[2], round(w[3], 6), w[4]) for w in want]


HELPERS = ["_row", "row", "doc", "_text", "text_key", "n_removed", "n_lines", "gone", "kept", "host", "n_words", "base_failed", "fp", "root", "_d", "_k", "_stays", "size", "target", "taken", "copies", "key"]


def test_stages_take_columns_named_as_their_own(spark, tmp_path):
    docs, items = corpus(5)
    rows = [(d, t, "en", s, len(t or ""), *range(len(HELPERS))) for d, t, s in docs[:40]]
    ddl = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{h}` int" for h in HELPERS)
    df = spark.createDataFrame(rows, ddl)
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, df, str(tmp_path))
        assert after.columns == df.columns
        assert all(tuple(r)[5:] == tuple(range(len(HELPERS))) for r in after.collect())
    assert corpus_pipeline.mixing_to_weights(spark, df, str(tmp_path)).count() == 40


ELSEWHERE = """
import sys
sys.path.insert(0, sys.argv[1])
import __spark_entry__ as entry
from compare import spark_session
spark = spark_session()
for name, query in entry.queries().items():
    if name == "pipeline" or name.startswith("op") and name[2].isdigit():
        print(name, query(spark, sys.argv[2]).count() > 0)
"""


@given
def test_workers_need_not_find_the_library(tmp_path):
    root = str(Path(entry.__file__).resolve().parent)
    bare = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"} | {"BENCH_CPUS": "4"}
    done = subprocess.run([sys.executable, "-c", ELSEWHERE, root, FOLDER], cwd=tmp_path, env=bare, capture_output=True, text=True, timeout=900)
    assert done.returncode == 0, done.stderr[-3000:]
    found = dict(line.split() for line in done.stdout.splitlines() if line.endswith(("True", "False")))
    assert set(found) == {*queries.queries(), "pipeline"} and set(found.values()) == {"True"}


def test_stages_pass_documents_on(spark, tmp_path):
    docs, items = corpus(4)
    rows = [(d, t, "en", s, len(t or ""), 1) for d, t, s in docs]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, words int")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES][-1] == "mixing"
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, df, str(tmp_path))
        assert after.columns == df.columns
        assert after.where("n_chars <> char_length(text)").count() == 0
        none = stage(spark, df.limit(0), str(tmp_path))
        assert none.columns == df.columns and none.count() == 0
