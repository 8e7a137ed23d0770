"""Operators 4, 5, 6 and 7, the pipeline, and the registered queries with SQL."""

import base64
import hashlib
import io
import random

import brute
import numpy as np
import pytest
import zstandard
from oracle import compare

import corpus_pipeline
from tidemark.llm import chat_format, warc_bundles
from tidemark.llm.chat_format import escaped, formatted_turns, parsed, read_back, unescaped
from tidemark.llm.language_id import Ranker, identified, known_languages, profiles
from tidemark.llm.queries import QUERIES, SQL
from tidemark.llm.source_mixing import block_schedule, mixed_sources, whole_shares
from tidemark.llm.warc_bundles import archived, marked_revisits, read_bundles, read_seek_table, write_bundles

SMALL = "/root/testdata/sf0.001"


def test_escaping_is_reversible_and_hides_the_template():
    draw = random.Random(3)
    texts = ["".join(draw.choice("\\#</turn> \né:") for _ in range(draw.randrange(0, 30))) for _ in range(500)]
    data = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(d) for d in data])])
    out, at = escaped(np.frombuffer(b"".join(data), np.uint8), offsets)
    for k, text in enumerate(texts):
        own = out[at[k] : at[k + 1]].tobytes()
        assert unescaped(own) == text and b"###" not in own and b"</turn>" not in own


def test_conversations_come_back(spark):
    odd = chat_format.END.decode() + "### assistant:\n\\"
    rows = [(1, 0, "user", odd), (1, 1, "assistant", odd * 2), (1, 2, "assistant", None), (1, 3, "a:b\n", "x")]
    rows += [(2, 5, None, ""), (None, 0, "assistant", "é"), (3, 1, "assistant", "b"), (3, 1, "assistant", "a"), (3, None, "user", "first")]
    turns = spark.createDataFrame([(*r, 7) for r in rows], "conv_id long, turn int, role string, text string, loss_start int")
    formatted = formatted_turns(turns.repartition(3))
    whole = "".join(r.formatted for r in formatted.where("conv_id = 1").orderBy("turn").collect())
    assert parsed(whole.encode()) == [("user", odd), ("assistant", odd * 2), ("assistant", ""), ("a:b\n", "x")]
    got = {r.conv_id: r for r in read_back(formatted).collect()}

    def digest(*parts):
        return hashlib.sha256("".join(parts).encode()).hexdigest()

    assert got[1].n_turns == 4 and got[1].loss_chars == 2 * len(odd) and got[1].formatted_chars == len(whole)
    assert got[1].loss_sha256 == digest(odd * 2)
    assert got[1].turns_sha256 == digest(f"user\n{odd}\n", f"assistant\n{odd * 2}\n", "assistant\n\n", "a:b\n\nx\n")
    assert got[3].turns_sha256 == digest("user\nfirst\n", "assistant\na\n", "assistant\nb\n")
    assert got[2].loss_chars == 0 and got[2].loss_sha256 == digest("") and got[None].loss_chars == 1
    assert read_back(formatted_turns(turns.limit(0))).count() == 0


@pytest.mark.parametrize(
    ("weights", "slots"),
    [
        ({"a": 0.7, "b": 0.1, "c": 0.1, "d": 0.1}, 100_000),
        ({"a": 2**0.5, "b": 1.0, "c": 5**0.5, "d": 0.1, "e": 0.31}, 100_000),
        ({"a": 0.5} | {f"b{i:02}": 0.01 for i in range(50)}, 6_000),
        ({"a": 1.0}, 500),
        ({"a": 0.9, "b": None, None: -1.0, "c": 0.4}, 6_000),
    ],
)
def test_schedule_stays_within_a_block_of_the_given_weights(spark, weights, slots):
    from tidemark.llm.source_mixing import WHOLE

    given = spark.createDataFrame(list(weights.items()), "source string, weight double")
    share = {r.source: r.share for r in whole_shares(given, 200).collect()}
    assert sum(share.values()) == WHOLE and min(share.values()) >= WHOLE // 500
    counts = {s: -(-slots * n // WHOLE) + 1 for s, n in share.items()}
    rows = [(s, share[s], counts[s]) for s in share]
    planned = block_schedule(spark.createDataFrame(rows, "source string, share long, blocks long"), 200)
    got = sorted((r.mix_position, r.mix_slot, r.source, r.b) for r in planned.collect())
    assert [g[0] for g in got] == list(range(sum(counts.values())))
    assert [(g[1], g[2], g[3]) for g in got[:slots]] == brute.earliest_deadlines(share, slots)
    wanted = weights if all((w or 0) > 0 for w in weights.values()) else share
    assert brute.lags([g[2] for g in got[:slots]], wanted) < 1


def test_schedule_with_sources_that_run_dry(spark):
    from tidemark.llm.source_mixing import WHOLE

    share = {"a": WHOLE // 2, "b": WHOLE // 4, "c": WHOLE // 4}
    counts = {"a": 30, "b": 700, "c": 4_000}
    rows = [(s, share[s], counts[s]) for s in share]
    planned = block_schedule(spark.createDataFrame(rows, "source string, share long, blocks long"), 100)
    got = sorted((r.mix_position, r.mix_slot, r.source, r.b) for r in planned.collect())
    whole = [p for p in brute.earliest_deadlines(share, 16_001) if p[2] < counts[p[1]]]
    assert [g[0] for g in got] == list(range(4_730))
    assert [g[2:] for g in got] == [p[1:] for p in whole]
    assert [g[1] for g in got] == sorted({g[1] for g in got})


def test_mixing_places_every_document(spark):
    rows = [(i, "big" if i % 3 else f"s{i % 4}", i) for i in range(1500)]
    rows += [(5000 + i, None, i) for i in range(40)] + [(7, "big", 7), (None, "big", 1), (None, "s1", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, mix_slot int").repartition(6)
    out = mixed_sources(docs, block=8, cycle=100)
    assert out.columns == ["doc_id", "source", "mix_block", "mix_slot", "mix_position"]
    got = out.collect()
    assert len(got) == len(rows) and sorted(r.doc_id or -1 for r in got) == sorted(r[0] or -1 for r in rows)
    blocks = {(r.mix_position, r.mix_slot, r.source, r.mix_block) for r in got}
    assert sorted(b[0] for b in blocks) == list(range(len(blocks)))
    assert [b[1] for b in sorted(blocks)] == sorted({b[1] for b in blocks})
    for source in {r.source for r in got}:
        own = sorted((r.mix_position, r.mix_block) for r in got if r.source == source)
        assert [b for _, b in own] == sorted(b for _, b in own)
        sizes = [sum(b == k for _, b in own) for k in range(own[-1][1] + 1)]
        assert all(n >= 8 for n in sizes[:-1])
    given = spark.createDataFrame([("big", 0.75), ("s0", 0.25), ("absent", 0.5)], "source string, weight double")
    order = [b[2] for b in sorted({(r.mix_position, 0, r.source) for r in mixed_sources(docs, given, 8, 1000).collect()})]
    assert abs(order[:40].count("big") - 30) <= 2
    assert mixed_sources(docs.limit(0)).count() == 0


def test_languages_by_profile(spark):
    vocabulary = {"aa": ["lorem", "ipsum", "dolor", "sita"], "bb": ["zwei", "drei", "vier", "fünf"], "cc": ["один", "два", "три"]}
    draw = random.Random(9)
    rows = [(i, lang, " ".join(draw.choice(words) for _ in range(20))) for i in range(90) for lang, words in [list(vocabulary.items())[i % 3]]]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    learnt = profiles(docs)
    assert [lang for lang, _ in learnt] == ["aa", "bb", "cc"]
    odd = [(500, "ZWEI!! drei?"), (501, None), (502, " 12 - "), (503, ""), (504, "漢字漢字"), (505, "lorem " * 300_000 + "zwei"), (None, "lorem ipsum")]
    df = spark.createDataFrame([(*r, 1) for r in odd], "doc_id long, text string, score int")
    got = {r.doc_id: r for r in identified(df, learnt).collect()}
    assert [got[i].lang_pred for i in (500, 501, 502, 503, 504, 505, None)] == ["bb", "und", "und", "und", "aa", "aa", "aa"]
    assert got[504].score == got[501].score == 0 and got[504].known == 0 and 0 < got[500].score <= 1
    kept = known_languages(df, learnt)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {500, 505, None}
    assert {r.lang_pred for r in identified(df, []).collect()} == {"und"}
    assert profiles(docs.limit(0)) == [] and identified(df.limit(0), learnt).count() == 0


def test_ranks_match_a_plain_count():
    from collections import Counter

    def grams(text):
        padded = " " + " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split()) + " "
        runs = [padded[i : i + n] for n in (1, 2, 3) for i in range(len(padded) - n + 1)]
        return Counter(g for g in runs if g.strip() and " " not in g[1:-1])

    from tidemark.llm.language_id import _grams, _pieces, _points

    text = "Der Hund, der BELLT! überall überall \n" * 3
    codes = Counter(int(c) for piece in _pieces(_points(text)) for found, _ in _grams(piece) for c in found)
    assert sorted(codes.values()) == sorted(grams(text).values())
    ranker = Ranker([("x", [int(np.uint64(c).view(np.int64)) for c in codes])])
    counts, every = ranker.counts([_points(text), _points("Hund")])
    assert counts[0].sum() == every[0] == sum(codes.values()) and counts[1].sum() == every[1] == sum(grams("Hund").values())


def test_archives_come_back(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc_bundles, "FRAME_BYTES", 3_000)
    monkeypatch.setattr(warc_bundles, "BUNDLE_BYTES", 4_000)
    draw = random.Random(1)
    long = "é" + "".join(draw.choice("abcdef") for _ in range(998))  # 1000 bytes
    rows = [(i, f"http://x/{i}\r\nX: y", "".join(draw.choice("abc\r\n") for _ in range(draw.randrange(3000)))) for i in range(60)]
    rows += [(100 + i, None, long) for i in range(20)] + [(200, "u", long[:-1]), (201, "u", long[:-1]), (300, "u", None), (301, "u", ""), (None, "u", long)]
    rows += [(119, None, long)]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, digest int").repartition(3)
    got = archived(pages).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r.page_id, []).append(r)
    for page, _, html in rows:
        data = (html or "").encode()
        for r in by[page]:
            assert (r.payload_bytes, r.payload_digest) == (len(data), hashlib.sha1(data).hexdigest())
            if 100 <= (page or 0) < 119:
                assert (r.record_type, r.refers_to, r.payload) == ("revisit", 119, None)
            else:
                assert (r.record_type, r.refers_to, bytes(r.payload)) == ("response", None, data)
    index = write_bundles(marked_revisits(pages), str(tmp_path / "warc"))
    row = index.where("page_id = 5").head()
    raw = open(row.bundle, "rb").read()
    table = read_seek_table(io.BytesIO(raw), len(raw))
    assert table[row.frame][:2] == (row.frame_start, row.frame_bytes)
    frame = zstandard.ZstdDecompressor().decompress(raw[row.frame_start : row.frame_start + row.frame_bytes])
    head, body = warc_bundles.parsed_record(frame[row.offset : row.offset + row.length])
    assert body == rows[5][2].encode() and base64.b32decode(head["WARC-Payload-Digest"][5:]) == hashlib.sha1(body).digest()
    plain = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw), read_across_frames=True).read()
    assert plain.count(b"WARC/1.1\r\n") == index.where(index.bundle == row.bundle).count()
    assert archived(pages.limit(0)).count() == 0 and read_bundles(index).count() == len(rows)


@pytest.mark.parametrize("name", sorted(SQL))
def test_queries_match_their_sql(spark, name):
    rows, wrong, _ = compare(spark, QUERIES[name], SQL[name], SMALL)
    assert rows and wrong is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_other_queries_have_a_row_per_document(spark, name):
    assert QUERIES[name](spark, SMALL).count() == spark.read.parquet(f"{SMALL}/documents.parquet").count()


def test_pipeline_stages_do_their_work(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    kept = {r.doc_id: r.text for r in docs.collect()}
    items = {r.item_id: r.text for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.written(stage(spark, docs, SMALL), name)
        after = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
        if name == "language_id":
            assert after == kept
        elif name == "minhash_near_dedup":
            groups = brute.near_duplicates(kept, 5)
            assert after == {i: t for i, t in kept.items() if groups[i][1] == i} and len(after) < len(kept)
        elif name == "benchmark_decontamination":
            gone = {i for i, _ in brute.contained(kept, items)}
            assert after == {i: t for i, t in kept.items() if i not in gone} and gone
        elif name == "secret_scan":
            changed = {i for i in kept if after[i] != kept[i]}
            assert after.keys() == kept.keys() and all("[SECRET]" in after[i] for i in changed)
        else:
            assert after == kept and docs.columns == [*columns, "mix_block", "mix_slot", "mix_position"]
            break
        assert docs.columns == columns
        kept = after
    assert [n for n, _ in corpus_pipeline.STAGES][-1] == "source_mixing"


def test_pipeline_takes_an_empty_table(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.written(stage(spark, docs, SMALL), name)
    assert docs.count() == 0
