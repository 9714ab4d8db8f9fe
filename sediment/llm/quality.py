"""Quality rules: counts per document, and verdicts on whole hosts.

A document fails by itself if it is short or repeats itself. Beyond that, failures of every rule are summed per
host, and each host's rate is shrunk towards the corpus by an empirical beta prior. A document that fails a rule goes if its host
is clearly above the corpus in that rule, and all documents of a host whose shrunk rate of any rule is above the limit go.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sediment.llm.words import SPACES, split_words, text_key, whole
from sediment.operators.lookup import Sized, lookup
from sediment.staging import Staging

SYMBOLS = r"[#*$%&|<>]"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class QualityParams:
    min_words: int = 50
    # A document fails if more than this share of its words lies in repeated three-word windows.
    repeat_percent: int = 50
    # Symbols per 100 words, repeated lines per 100 lines, and bounds of the mean word length.
    symbol_percent: int = 20
    dup_line_percent: int = 40
    word_length: tuple[int, int] = (2, 15)
    # A host goes if the shrunk rate of a rule is above this.
    host_rate: float = 0.9
    # A host is clearly above the corpus if its shrunk rate, less so many standard deviations, has so many times the corpus's odds.
    host_deviations: float = 3.0
    host_odds: float = 2.0


def repeated_words(words: Column) -> Column:
    """Number of words in three-word windows that occur at least twice.

    The windows are sorted with their places, so equal ones are neighbours: n log n in the document's length,
    no shuffle, and equality is that of the words.
    """
    n = F.size(words)
    windows = F.arrays_zip(
        words.alias("a"), F.slice(words, 2, n).alias("b"), F.slice(words, 3, n).alias("c"), F.sequence(F.lit(1), n).alias("p")
    )
    ordered = F.sort_array(F.slice(windows, 1, n - 2))
    pairs = F.arrays_zip(F.slice(ordered, 1, n - 3).alias("x"), F.slice(ordered, 2, n).alias("y"))
    same = F.filter(pairs, lambda z: (z.x.a == z.y.a) & (z.x.b == z.y.b) & (z.x.c == z.y.c))
    places = F.flatten(
        F.transform(same, lambda z: F.array(z.x.p, z.x.p + 1, z.x.p + 2, z.y.p, z.y.p + 1, z.y.p + 2))
    )
    return F.when(n >= 4, F.size(F.array_distinct(places))).otherwise(0)


def with_counts(rows: DataFrame) -> DataFrame:
    """Adds COUNTS and `n_lines` (lines with a word) to rows with a `text`; a null text has no words."""
    split = rows.withColumns(
        {
            "_words": split_words(F.col("text"), SPACES),
            "_lines": F.filter(F.split(whole(F.col("text")), "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
        }
    )
    counts = {
        "n_words": F.size("_words"),
        "word_chars": F.char_length(F.array_join("_words", "")),
        "n_symbols": F.regexp_count(whole(F.col("text")), F.lit(SYMBOLS)),
        "n_dup_lines": F.size("_lines") - F.size(F.array_distinct("_lines")),
        "n_repeat_words": repeated_words(F.col("_words")),
        "n_lines": F.size("_lines"),
    }
    return split.withColumns({k: v.cast("long") for k, v in counts.items()}).drop("_words", "_lines")


def failures(params: QualityParams) -> dict[str, Column]:
    """The rules: name -> whether a document with COUNTS fails."""
    low, high = params.word_length
    n, c = F.col("n_words"), F.col
    return {
        "short": n < params.min_words,
        "repeats": 100 * c("n_repeat_words") > params.repeat_percent * n,
        "symbols": 100 * c("n_symbols") > params.symbol_percent * n,
        "dup_lines": 100 * c("n_dup_lines") > params.dup_line_percent * c("n_lines"),
        "word_length": (c("word_chars") < low * n) | (c("word_chars") > high * n),
    }


def host_rates(judged: DataFrame, rules: tuple[str, ...], params: QualityParams = QualityParams()) -> DataFrame:
    """One row per host (not null): documents `n`, each rule's shrunk failure rate `rate_<rule>`, and `above_<rule>`, whether it is
    clearly above the rate of all documents that have a host.

    The prior is a beta distribution fitted to all hosts' rates by moments: mean m of the rates, and strength
    m(1-m)/v - 1 from their variance v less the mean sampling variance. Hosts that differ no more than chance would make them
    get a strength of 10^6, so nearly the common rate. Only the prior's sums and the documents' common rate per rule come to the driver.
    """
    hosts = judged.where(F.col("host").isNotNull()).groupBy("host").agg(
        F.count(F.lit(1)).alias("n"), *(F.sum(F.col(f"fails_{r}").cast("long")).alias(f"k_{r}") for r in rules)
    )
    moments = []
    for r in rules:
        p = F.col(f"k_{r}") / F.col("n")
        moments += [F.avg(p).alias(f"m_{r}"), F.var_pop(p).alias(f"v_{r}"), F.avg(p * (1 - p) / F.col("n")).alias(f"s_{r}")]
        moments.append((F.sum(f"k_{r}") / F.sum("n")).alias(f"c_{r}"))
    found = hosts.agg(*moments).first()
    out = hosts
    for r in rules:
        m, v, s = (found[f"{x}_{r}"] or 0.0 for x in "mvs")
        common = found[f"c_{r}"] or 0.0
        spread = max(v - s, 0.0)
        strength = min(max(m * (1 - m) / spread - 1, 1.0), 1e6) if spread > 0 else 1e6
        size = F.col("n") + F.lit(strength)
        rate = (F.col(f"k_{r}") + F.lit(m * strength)) / size
        low = rate - params.host_deviations * F.sqrt(rate * (1 - rate) / (size + 1))
        out = out.withColumns({f"rate_{r}": rate, f"above_{r}": low * (1 - common) > params.host_odds * common * (1 - low)})
    return out.select("host", "n", *(f"rate_{r}" for r in rules), *(f"above_{r}" for r in rules))


def judge(
    docs: DataFrame,
    text: str = "text",
    host: str = "source",
    params: QualityParams = QualityParams(),
    drop_text: bool = False,
) -> DataFrame:
    """One row per document: `doc` (the whole given row, less the text if so asked), COUNTS, `base_failed`, `host_failed`, `rule_failed`, `kept`.

    `host_failed`: the whole host goes; `rule_failed`: the document fails a rule in which its host is clearly above the corpus.

    A null text counts as empty and fails as short; rows without a host get no host verdict; repeated rows are judged alike
    and all count for their host; an empty table gives none. Given columns lie inside `doc`, so no name clashes.
    The text is read once: the judged rows are written to the checkpoint folder and joined with the hosts there.
    """
    carried = [f"`{c}`" for c in docs.columns if not (drop_text and c == text)]
    named = {"text": F.col(f"`{text}`").cast("string"), "host": F.col(f"`{host}`").cast("string")}
    counted = with_counts(docs.select(F.struct(*carried).alias("doc"), *(v.alias(k) for k, v in named.items())))
    rules = failures(params)
    named = counted.select("doc", "host", *COUNTS, *(v.alias(f"fails_{r}") for r, v in rules.items()))
    written = Staging(docs.sparkSession).write("judged", named)
    rates = host_rates(written, tuple(rules), params)
    failed = F.greatest(*(F.col(f"rate_{r}") for r in rules)) > params.host_rate
    above = {f"above_{r}": f"fails_{r}" for r in rules}
    bad = rates.select("host", F.when(failed, F.lit(True)).alias("bad"), *above).where(reduce(or_, map(F.col, above), F.col("bad").isNotNull()))
    marked = lookup(written, Sized.of(bad), {"host": "host"}, {"bad": "host_failed", **{a: a for a in above}})
    by_rule = F.coalesce(reduce(or_, (F.col(a) & F.col(f) for a, f in above.items())), F.lit(False))
    base = F.col("fails_short") | F.col("fails_repeats")
    return marked.select(
        "doc",
        *COUNTS,
        base.alias("base_failed"),
        F.coalesce("host_failed", F.lit(False)).alias("host_failed"),
        by_rule.alias("rule_failed"),
        (~base & F.col("host_failed").isNull() & ~by_rule).alias("kept"),
    )


def kept_rows(docs: DataFrame, doc: str = "doc_id", text: str = "text", host: str = "source", params: QualityParams = QualityParams()) -> DataFrame:
    """The given rows that `judge` keeps.

    Only verdicts are written, not texts: rejected rows go by id, key of the text and host, on which a verdict hangs, so
    repeated rows go or stay together. Nulls in any of these are values like others, an empty table gives none, and other columns may have any name.
    Texts are shuffled only if the rejected rows are too many to broadcast.
    """
    t, h = F.col(f"`{text}`").cast("string"), F.col(f"`{host}`").cast("string")
    named = docs.select(F.col(f"`{doc}`").alias("_d"), text_key(t).alias("_k"), h.alias("_h"), t.alias("_t"))
    rejected = judge(named, "_t", "_h", params, drop_text=True).where("not kept").select("doc._d", "doc._k", "doc._h").distinct()
    sized = Sized.of(Staging(docs.sparkSession).write("rejected", rejected))
    given = docs.select(F.struct("*").alias("row"))
    of = {k: F.col(f"row.`{c}`") for k, c in (("d", doc), ("t", text), ("h", host))}
    same = of["d"].eqNullSafe(F.col("_d")) & (text_key(of["t"].cast("string")) == F.col("_k")) & of["h"].cast("string").eqNullSafe(F.col("_h"))
    return given.join(F.broadcast(sized.df) if sized.fits() else sized.df, same, "left_anti").select("row.*")
