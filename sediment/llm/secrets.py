"""Secret scans with corpus-wide ownership of every candidate.

Candidates are found by patterns in whole texts. A digest of each one's secret part is then counted over the corpus: in how
many repositories, of how many owners it occurs. What many owners have is a copied example; what few have looks live.
Candidates of the base kinds are reported either way, those of further kinds only if they look live.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from sediment.llm.words import text_key
from sediment.operators.lookup import Sized, lookup
from sediment.staging import Staging

# The base kinds in their order. Case folding is that of A-Z only.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
BASE = ("assign", "access", "hex")
# Published formats of credentials beyond the base kinds.
FURTHER = {
    "private_key": re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]+-----END [A-Z ]*PRIVATE KEY-----"),
    "jwt": re.compile(r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    "prefixed": re.compile(r"(?:gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|sk-[A-Za-z0-9]{20,}|AIza[A-Za-z0-9_-]{35})"),
}
OPAQUE = re.compile(r"[A-Za-z0-9+/_-]{32,}={0,2}")
KINDS = (*BASE, *FURTHER, "opaque")


@dataclass(frozen=True)
class SecretParams:
    # From this many owners on a candidate is a copied example.
    example_owners: int = 3
    # Bits per character from which an opaque string with all of a-z, A-Z and 0-9 is a candidate.
    min_entropy: float = 4.0


def entropy(text: str) -> float:
    n = len(text)
    return -sum(c / n * math.log2(c / n) for c in Counter(text).values())


def find(text: str, params: SecretParams = SecretParams()) -> list[tuple[int, int, int, str]]:
    """(start, kind's place in KINDS, end, secret part) of all candidates, by start, then kind."""
    found = []
    if ":" in text or "=" in text:
        found += [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end(), m[0]) for m in HEX.finditer(text)]
    taken = [(s, e) for s, _, e, _ in found]
    further = []
    for k, (name, pattern) in enumerate(FURTHER.items(), len(BASE)):
        if {"private_key": "-----BEGIN", "jwt": "eyJ"}.get(name, "") in text:
            further += [(m.start(), k, m.end(), m[0]) for m in pattern.finditer(text)]
    for m in OPAQUE.finditer(text):
        t = m[0]
        if any(c.islower() for c in t) and any(c.isupper() for c in t) and any(c.isdigit() for c in t) and entropy(t) >= params.min_entropy:
            further.append((m.start(), len(KINDS) - 1, m.end(), t))
    # Of what overlaps, the base kinds come first, then the earlier kind.
    for s, k, e, t in sorted(further, key=lambda x: (x[1], x[0])):
        if all(e <= a or b <= s for a, b in taken):
            taken.append((s, e))
            found.append((s, k, e, t))
    return sorted(found)


FOUND = "array<struct<start:int,kind:int,end:int,digest:binary>>"


def candidates(rows: DataFrame, params: SecretParams = SecretParams()) -> DataFrame:
    """`rows` with `text` replaced by `found`: places, kinds and digests; the secrets themselves go no further."""
    rest = [c for c in rows.columns if c != "text"]
    schema = rows.drop("text").schema.add("found", DataType.fromDDL(FOUND))
    item = pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32()), ("digest", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                [
                    {"start": s, "kind": k, "end": e, "digest": hashlib.sha256(t.encode("utf-8", "surrogatepass")).digest()}
                    for s, k, e, t in find(x.as_py() or "", params)
                ]
                for x in batch.column("text")
            ]
            columns = [batch.column(c) for c in rest]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found, pa.list_(item))], names=[*rest, "found"])

    return rows.mapInArrow(run, schema)


def ownership(found: DataFrame) -> DataFrame:
    """`digest`, `repositories`, `owners`: distinct ones that hold it; nulls count as one.

    Counted in steps from (digest, owner, repository) up, each with partial sums, so a digest that a third of all
    rows hold is a row per task by the second step.
    """
    each = found.select("owner", "repository", F.explode("found.digest").alias("digest"))
    repositories = each.groupBy("digest", "owner", "repository").agg(F.lit(1).alias("one"))
    owners = repositories.groupBy("digest", "owner").agg(F.count(F.lit(1)).alias("repositories"))
    return owners.groupBy("digest").agg(F.sum("repositories").alias("repositories"), F.count(F.lit(1)).alias("owners"))


def scan_secrets(
    docs: DataFrame,
    doc: str = "doc_id",
    text: str = "text",
    owner: str = "source",
    repository: str = "doc_id",
    params: SecretParams = SecretParams(),
) -> DataFrame:
    """One row per distinct (doc_id, text, owner): `doc_id`, `copies`, `spans`: (start, kind, end, owners, repositories, live), by start, then kind.

    `kind` is a place in KINDS; ends are exclusive; places count code points. A null or empty text has no
    spans; rows alike in id, text and owner are one row with `copies`; a null owner is an owner of its own; an empty
    table gives no rows. Only digests are shuffled, and only those of examples are joined back.
    """
    t = F.col(text).cast("string")
    rows = docs.select(
        F.col(doc).alias("doc_id"),
        text_key(t).alias("text_key"),
        F.col(owner).cast("string").alias("owner"),
        F.col(repository).cast("string").alias("repository"),
        t.alias("text"),
    )
    staging = Staging(docs.sparkSession)
    found = staging.write("found", candidates(rows, params))
    counts = staging.write("owners", ownership(found))
    spans = found.select("doc_id", "text_key", "owner", F.posexplode_outer("found").alias("i", "s")).select("doc_id", "text_key", "owner", "i", "s.*")
    shared = counts.where(F.col("owners") > 1).select("digest", F.struct("owners", "repositories").alias("c"))
    sized = Sized.of(shared.select("digest"))
    known = Sized(shared, sized.rows, sized.bytes + 32 * sized.rows)
    spans = lookup(spans, known, {"digest": "digest"}, {"c": "c"}, spread=("doc_id", "i"))
    owners = F.coalesce(F.col("c.owners"), F.lit(1))
    span = F.struct(
        "start",
        "kind",
        "end",
        owners.alias("owners"),
        F.coalesce(F.col("c.repositories"), F.lit(1)).alias("repositories"),
        (owners < params.example_owners).alias("live"),
    )
    keep = F.col("start").isNotNull() & ((F.col("kind") < len(BASE)) | (owners < params.example_owners))
    # Place 0 stands in every document, with a span or without, so it counts the copies.
    per_doc = spans.groupBy("doc_id", "text_key", "owner").agg(
        F.count(F.when(F.coalesce("i", F.lit(0)) == 0, 1)).alias("copies"), F.array_sort(F.collect_set(F.when(keep, span))).alias("spans")
    )
    return per_doc.select("doc_id", "copies", "spans")
