"""Secrets in documents, told apart by how widely their values are copied.

Every text is scanned whole for assignments, access keys and hexadecimal runs (the base
kinds) and for other token-like strings. The hash of every candidate value is aggregated
over the corpus into the number of distinct repositories and of distinct owners that hold
it. A value of many owners is an example that people copy; one of few owners is their own
and looks live. Base spans are always reported; a token-like string is reported, as kind
``live``, only if its value belongs to few owners.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import written

# The kinds in their order, and their patterns.
KINDS = ("assign", "access", "hex", "live")
ASSIGN = re.compile(
    r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
TOKEN = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{24,}")
MIN_VALUE = 8  # of an assignment
MIN_ENTROPY = 3.5  # bits per character of a token-like string

#: Values of this many owners or more count as copied examples.
WIDE_OWNERS = 4

_SPAN = "struct<start:long,rank:int,end:long,value:string>"


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """``start, rank of kind, end, value`` of the base kinds, by start and kind, in code points."""
    found = [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_VALUE]
    found += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end(), m[0]) for m in HEX.finditer(text)]
    return sorted(found)


def token_spans(text: str, base: list[tuple[int, int, int, str]]) -> list[tuple[int, int, int, str]]:
    """Token-like strings outside the base spans: digits and letters mixed, high entropy."""
    starts, ends = [], []  # the base spans, those that meet made one
    for start, _, end, _ in sorted(base):
        if ends and start < ends[-1]:
            ends[-1] = max(ends[-1], end)
        else:
            starts.append(start)
            ends.append(end)
    found = []
    for m in TOKEN.finditer(text):
        value = m[0]
        if any(c.isalpha() for c in value) and any(c.isdigit() for c in value) and _entropy(value) >= MIN_ENTROPY:
            last = bisect_left(starts, m.end()) - 1
            if last < 0 or ends[last] <= m.start():
                found.append((m.start(), 3, m.end(), value))
    return found


def _entropy(value: str) -> float:
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values())


def _joined(spans: list[tuple[int, int, int, str]]) -> str:
    return ",".join(f"{KINDS[rank]}:{start}:{end}" for start, rank, end, _ in spans)


def scanned(docs: DataFrame, owner: Column, repository: Column) -> DataFrame:
    """A row per document: counts and digest of the base spans, and all candidates.

    ``text_key`` names the text; values are kept as hashes only.
    """
    out = pa.schema(
        [("doc_id", pa.int64()), ("text_key", pa.int64()), ("owner", pa.string()), ("repository", pa.string()),
         ("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()), ("base_sha256", pa.string()),
         ("found", pa.list_(pa.struct([("start", pa.int64()), ("rank", pa.int32()), ("end", pa.int64()), ("value", pa.string())])))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, digests, spans = [], [], []
            for cell in batch.column("text"):
                text = cell.as_py() or ""
                base = base_spans(text)
                counts.append([sum(rank == k for _, rank, _, _ in base) for k in range(3)])
                digests.append(hashlib.sha256(_joined(base).encode()).hexdigest())
                spans.append(
                    [
                        {"start": s, "rank": r, "end": e, "value": hashlib.sha256(v.encode()).hexdigest()[:32]}
                        for s, r, e, v in base + token_spans(text, base)
                    ]
                )
            yield pa.RecordBatch.from_arrays(
                [batch.column(n) for n in ("doc_id", "text_key", "owner", "repository")]
                + [pa.array([c[k] for c in counts], pa.int64()) for k in range(3)]
                + [pa.array(digests, pa.string()), pa.array(spans, out.field("found").type)],
                schema=out,
            )

    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(F.col("text").cast("string")).alias("text_key"),
        owner.cast("string").alias("owner"),
        repository.cast("string").alias("repository"),
        F.col("text").cast("string").alias("text"),
    )
    return narrow.mapInArrow(
        run,
        "doc_id long, text_key long, owner string, repository string, n_assign long, n_access long, "
        f"n_hex long, base_sha256 string, found array<{_SPAN}>",
    )


def value_owners(found: DataFrame) -> DataFrame:
    """``value, n_repositories, n_owners``: distinct holders of every candidate value.

    Counted in two steps, per value and owner first, so that a value copied everywhere is
    summed on the map side and never gathered. A null owner or repository counts as one.
    """
    held = found.select(
        F.coalesce("owner", F.lit("")).alias("owner"),
        F.coalesce("repository", F.lit("")).alias("repository"),
        F.explode("found.value").alias("value"),
    )
    owned = held.distinct().groupBy("value", "owner").agg(F.count("*").alias("n"))
    return owned.groupBy("value").agg(F.sum("n").alias("n_repositories"), F.count("*").alias("n_owners"))


def judged_spans(
    docs: DataFrame, owner: Column | None = None, repository: Column | None = None, wide_owners: int = WIDE_OWNERS
) -> tuple[DataFrame, DataFrame]:
    """The scanned documents, and per (doc_id, text_key) the reported spans with their verdicts."""
    owner = F.col("source") if owner is None else owner
    repository = F.col("doc_id") if repository is None else repository
    found = written(scanned(docs, owner, repository), "scan")
    holders = value_owners(found)
    spans = (
        found.where(F.size("found") > 0)
        .select("doc_id", "text_key", F.explode("found").alias("s"))
        .distinct()
        .select("doc_id", "text_key", "s.*")
        .join(holders, "value")
        .withColumn("live", F.col("n_owners") < wide_owners)
        .where((F.col("rank") < len(KINDS) - 1) | F.col("live"))
    )
    return found, spans


def scan_secrets(
    docs: DataFrame, owner: Column | None = None, repository: Column | None = None, wide_owners: int = WIDE_OWNERS
) -> DataFrame:
    """A row per document: ``doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_copied``.

    ``spans`` lists ``kind:start:end`` by start and kind, in code points, end exclusive;
    ``base_sha256`` is the digest of the base ones alone. ``n_live`` and ``n_copied`` count
    the reported spans by verdict. ``owner`` defaults to ``source`` and ``repository`` to
    ``doc_id``: the table has nothing nearer to them.

    A null text counts as empty and has no spans. A null or repeated ``doc_id`` is kept, a
    row for each row. An empty table gives no rows; other columns are ignored.
    """
    found, spans = judged_spans(docs, owner, repository, wide_owners)
    listed = (
        spans.groupBy("doc_id", "text_key")
        .agg(
            F.array_sort(F.collect_list(F.struct("start", "rank", "end"))).alias("all"),
            F.sum(F.col("live").cast("long")).alias("live"),
            F.count("*").alias("n"),
        )
        .withColumn(
            "spans",
            F.array_join(
                F.transform(
                    "all",
                    lambda s: F.concat_ws(
                        ":", F.element_at(F.array(*[F.lit(k) for k in KINDS]), s["rank"] + 1), s["start"], s["end"]
                    ),
                ),
                ",",
            ),
        )
        .select(F.col("doc_id").alias("d"), F.col("text_key").alias("t"), "spans", "live", "n")
    )
    joined = found.join(listed, found.doc_id.eqNullSafe(F.col("d")) & found.text_key.eqNullSafe(F.col("t")), "left")
    live = F.coalesce("live", F.lit(0))
    return joined.select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256",
        F.coalesce("spans", F.lit("")).alias("spans"),
        live.alias("n_live"),
        (F.coalesce("n", F.lit(0)) - live).alias("n_copied"),
    )


def redacted(
    docs: DataFrame, owner: Column | None = None, wide_owners: int = WIDE_OWNERS, mark: str = "[SECRET]"
) -> DataFrame:
    """``docs`` with its columns; spans that look live are replaced by ``mark``.

    Copied examples stay. ``n_chars``, where it exists, follows the new text. Overlapping
    spans become one mark.
    """
    _, spans = judged_spans(docs, owner, None, wide_owners)
    cuts = (
        spans.where("live")
        .groupBy("doc_id", "text_key")
        .agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("__cuts"))
        .select(F.col("doc_id").alias("__d"), F.col("text_key").alias("__t"), "__cuts")
    )
    # Between the cuts lie the kept pieces: from the furthest end so far to the next start.
    pieces = F.aggregate(
        "__cuts",
        F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("text")),
        lambda done, cut: F.struct(
            F.greatest(done["at"], cut["end"]).alias("at"),
            F.when(
                cut["start"] >= done["at"],
                F.concat(
                    done["text"],
                    F.substring(F.col("text"), (done["at"] + 1).cast("int"), (cut["start"] - done["at"]).cast("int")),
                    F.lit(mark),
                ),
            ).otherwise(done["text"]).alias("text"),
        ),
        lambda done: F.concat(done["text"], F.substring(F.col("text"), (done["at"] + 1).cast("int"), F.lit(2**31 - 1))),
    )
    key = F.xxhash64(F.col("text").cast("string"))
    joined = docs.withColumn("__key", key).join(
        cuts, F.col("doc_id").cast("long").eqNullSafe(F.col("__d")) & (F.col("__key") == F.col("__t")), "left"
    )
    out = joined.withColumn("text", F.when(F.col("__cuts").isNotNull(), pieces).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed = F.length("text").cast(kind)
        out = out.withColumn("n_chars", F.when(F.col("__cuts").isNotNull(), changed).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)
