"""Language of a document by rank-order profiles of character n-grams.

After Cavnar and Trenkle (1994): the profile of a language lists its most frequent n-grams
of one to three letters in order of frequency, a document is ranked likewise, and the
language whose profile is the least out of place, summed over the document's n-grams, wins.
Here documents rank the n-grams that occur in any profile, so that a text of any length is
counted into one row of a small table by numpy. An n-gram that a profile lacks is out of
place by the profile's full length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

#: n-grams of a profile, and of a document's ranking.
LENGTH = 400
#: Training documents per language that are expected in the sample (all, if there are fewer).
SAMPLE = 5_000

UNKNOWN = "und"
_PIECE = 1 << 20  # code points counted at a time
_SHIFT = 21  # bits of a code point


class _Letters:
    """Which code points are letters, built once per process."""

    table: np.ndarray | None = None

    @classmethod
    def of(cls, points: np.ndarray) -> np.ndarray:
        if cls.table is None:
            cls.table = np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)
        return cls.table[points]


def _points(text: str) -> np.ndarray:
    """Lower-case code points with one space (0) before, between and after the words."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    points = np.where(_Letters.of(points), points, np.uint32(0))
    padded = np.concatenate([[0], points, [0]]).astype(np.uint64)
    return padded[np.concatenate([[True], (padded[1:] != 0) | (padded[:-1] != 0)])]


def _grams(points: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Codes of all n-grams and where they start; none spans two words."""
    yield points[points != 0], np.flatnonzero(points)
    if len(points) > 1:
        two = points[:-1] | (points[1:] << np.uint64(_SHIFT))
        kept = np.flatnonzero((points[:-1] != 0) | (points[1:] != 0))
        yield two[kept] | np.uint64(1 << 63), kept
    if len(points) > 2:
        three = points[:-2] | (points[1:-1] << np.uint64(_SHIFT)) | (points[2:] << np.uint64(2 * _SHIFT))
        kept = np.flatnonzero((points[1:-1] != 0) & ((points[:-2] != 0) | (points[2:] != 0)))
        yield three[kept], kept


def _pieces(points: np.ndarray) -> Iterator[np.ndarray]:
    """The points in parts of about a million, cut at spaces, which belong to both sides."""
    at = 0
    while len(points) - at > _PIECE:
        gaps = np.flatnonzero(points[at + 1 : at + _PIECE] == 0)
        end = at + 1 + int(gaps[-1]) if len(gaps) else len(points) - 1
        yield points[at : end + 1]
        at = end
    yield points[at:]


def profiles(docs: DataFrame, length: int = LENGTH, sample: int = SAMPLE) -> list[tuple[str, list[int]]]:
    """Languages with the codes of their most frequent n-grams, most frequent first.

    Learns from the rows whose ``text`` and ``lang`` are not null. Of a language with more
    than ``sample`` rows, those with the least hashes of ``doc_id`` are taken, about
    ``sample`` of them. Ties in frequency go to the smaller code. ``length`` n-grams per
    language are gathered. No rows, no languages.
    """
    rows = docs.where("text IS NOT NULL AND lang IS NOT NULL")
    sizes = rows.groupBy("lang").count().collect()  # a row per language
    part = F.pmod(F.xxhash64("doc_id", "lang"), F.lit(1 << 20)) / (1 << 20)
    shares = [F.when(F.col("lang") == r["lang"], F.lit(sample / r["count"])) for r in sizes if r["count"] > sample]
    taken = rows.where(part < F.coalesce(*shares, F.lit(1.0))).select("lang", "text")
    out = pa.schema([("lang", pa.string()), ("gram", pa.int64()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: dict[str, list[np.ndarray]] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
                for piece in _pieces(_points(text.as_py())):
                    held.setdefault(lang, []).extend(codes for codes, _ in _grams(piece))
                if sum(map(len, held[lang])) > 4 * _PIECE:
                    yield summed(lang, held.pop(lang))
            for lang, codes in held.items():
                yield summed(lang, codes)

    def summed(lang: str, codes: list[np.ndarray]) -> pa.RecordBatch:
        gram, n = np.unique(np.concatenate(codes), return_counts=True)
        return pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(gram), pa.string()), pa.array(gram.view(np.int64)), pa.array(n.astype(np.int64))],
            schema=out,
        )

    counted = taken.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = counted.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= length)
    found: dict[str, list[int]] = {}
    for row in sorted(top.select("lang", "rank", "gram").collect()):
        found.setdefault(row.lang, []).append(row.gram)
    return sorted(found.items())


class Ranker:
    """Distances of texts to profiles, a batch at a time."""

    def __init__(self, learnt: list[tuple[str, list[int]]], length: int = LENGTH):
        self.length = length
        self.languages = [lang for lang, _ in learnt]
        grams = sorted({g for _, codes in learnt for g in codes})
        self.grams = np.array(grams, dtype=np.int64).view(np.uint64)
        place = {g: i for i, g in enumerate(grams)}
        self.ranks = np.full((len(learnt), len(grams)), length, dtype=np.int32)
        for i, (_, codes) in enumerate(learnt):
            self.ranks[i, [place[g] for g in codes]] = np.arange(len(codes))
        # A table without collisions from n-gram to its number.
        self.bits, multiplier = 16, 0x9E3779B97F4A7C15
        while True:
            self.multiplier = np.uint64(multiplier)
            slots = (self.grams * self.multiplier) >> np.uint64(64 - self.bits)
            if len(np.unique(slots)) == len(slots):
                break
            multiplier = (multiplier * 0xD1342543DE82EF95 + 2) % (1 << 64) | 1
            self.bits = min(26, self.bits + 1)
        self.table = np.full(1 << self.bits, -1, dtype=np.int32)
        self.table[slots] = np.arange(len(grams))

    def counts(self, batch: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """How often every known n-gram occurs in each text, and all n-grams of each text."""
        owner = np.repeat(np.arange(len(batch)), [len(p) for p in batch])
        known = np.zeros(len(batch) * len(self.grams), dtype=np.int64)
        every = np.zeros(len(batch), dtype=np.int64)
        joined = np.concatenate(batch)
        # Texts start and end with a space, so an n-gram over two texts has a space inside
        # or is two spaces.
        for codes, at in _grams(joined):
            number = self.table[(codes * self.multiplier) >> np.uint64(64 - self.bits)]
            hit = number >= 0
            hit[hit] = self.grams[number[hit]] == codes[hit]
            known += np.bincount(owner[at[hit]] * len(self.grams) + number[hit], minlength=len(known))
            every += np.bincount(owner[at], minlength=len(batch))
        return known.reshape(len(batch), -1), every

    def judge(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest language of every row of counts, and its lead over the next one."""
        order = np.argsort(-counts, axis=1, kind="stable")[:, : self.length]
        used = np.take_along_axis(counts, order, axis=1) > 0
        place = np.arange(order.shape[1])
        distance = np.stack(
            [(np.abs(ranks[order] - place) * used).sum(axis=1) for ranks in self.ranks], axis=1
        ).astype(np.float64)
        farthest = np.maximum(used.sum(axis=1) * float(self.length), 1.0)
        best = distance.argmin(axis=1)
        nearest = distance[np.arange(len(best)), best]
        if distance.shape[1] > 1:
            second = np.partition(distance, 1, axis=1)[:, 1]
        else:
            second = farthest
        score = np.where(used.any(axis=1), (second - nearest) / np.maximum(second, 1.0), 0.0)
        return best, np.clip(score, 0.0, 1.0)


def identified(docs: DataFrame, learnt: list[tuple[str, list[int]]], length: int = LENGTH) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``known``, judged by the whole ``text`` alone.

    ``score`` is the lead of the nearest profile over the next, as a share of the latter's
    distance; ``known`` is the share of the text's n-grams that occur in any profile.
    A null text and one without a letter are ``und`` with score 0, as is every text if no
    language was learnt. A text with letters but no known n-gram gets the first language
    by name and score 0; so do ties. Columns that bear the three names are replaced.
    """
    added = ["lang_pred", "score", "known"]
    docs = docs.drop(*added)
    schema = T.StructType(
        [
            *docs.schema.fields,
            T.StructField("lang_pred", T.StringType()),
            T.StructField("score", T.DoubleType()),
            T.StructField("known", T.DoubleType()),
        ]
    )
    ranker = Ranker(learnt, length) if learnt else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = [UNKNOWN] * batch.num_rows
            score, known = np.zeros(batch.num_rows), np.zeros(batch.num_rows)
            rows: list[int] = []
            held: list[np.ndarray] = []

            def settle():
                counts, every = ranker.counts(held)
                judge(rows, counts, every)
                rows.clear()
                held.clear()

            def judge(rows, counts, every):
                best, lead = ranker.judge(counts)
                for i, row in enumerate(rows):
                    if every[i]:
                        names[row] = ranker.languages[best[i]]
                        score[row] = lead[i]
                        known[row] = counts[i].sum() / every[i]

            for row, text in enumerate(batch.column("text")):
                points = _points(text.as_py() or "") if ranker else np.zeros(1, np.uint64)
                if len(points) == 1:
                    continue
                if len(points) > _PIECE:
                    parts = [ranker.counts([piece]) for piece in _pieces(points)]
                    judge([row], sum(c for c, _ in parts), sum(e for _, e in parts))
                    continue
                rows.append(row)
                held.append(points)
                if sum(map(len, held)) > _PIECE or len(held) >= 512:
                    settle()
            if rows:
                settle()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(names, pa.string()), pa.array(score), pa.array(known)],
                names=[*batch.schema.names, *added],
            )

    return docs.mapInArrow(run, schema)


def known_languages(docs: DataFrame, learnt: list[tuple[str, list[int]]], least_known: float = 0.1) -> DataFrame:
    """``docs`` with its columns, without texts that are in no learnt language.

    Those are null texts, texts without a letter, and texts of whose n-grams less than
    ``least_known`` occur in any profile.
    """
    added = ("lang_pred", "score", "known")
    judged = identified(docs.withColumnsRenamed({c: f"__own_{c}" for c in added if c in docs.columns}), learnt)
    kept = judged.where((F.col("lang_pred") != UNKNOWN) & (F.col("known") >= least_known))
    return kept.select(*[F.col(f"__own_{c}").alias(c) if c in added else F.col(c) for c in docs.columns])
