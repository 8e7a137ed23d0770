"""Operator 11 against the tokenizers library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidemark.llm import byte_pairs, queries
from tidemark.llm.byte_pairs import Vocabulary, decoded, encoded

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def vocabulary():
    with open(PATH, encoding="utf-8") as file:
        return Vocabulary(file.read())


def test_texts_of_every_script_match_the_library(library, vocabulary):
    draw = random.Random(2)
    pools = [
        "abcdefghij '  \n\t.,!?sStTreVm0123456789",
        "ÀÉßéüñøœİıΣσςΑΒ한글漢字ｆｉﬁ½²٣ ",
        "\u0301\u0308\u200b\u00a0\u2028\x85\x1c\x00\ufeff😀👍🏽",
    ]
    texts = []
    for _ in range(3_000):
        signs = []
        for _ in range(draw.randint(0, 30)):
            if draw.random() < 0.05:
                signs.append(draw.choice(["<|endoftext|>", "<|startoftext|>", "<|END", "'LL "]))
            elif draw.random() < 0.05:
                signs.append(chr(draw.choice([draw.randrange(0xD800), draw.randrange(0xE000, 0x110000)])))
            else:
                signs.append(draw.choice(draw.choice(pools)) * (1 if draw.random() < 0.95 else draw.randrange(40)))
        texts.append("".join(signs))
    expected = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [ids.tolist() for ids in vocabulary.encode(texts)] == expected


@pytest.mark.parametrize("length", [1, 2, 3, 4, 5, 63, 64, 65, 128, 20_000])
def test_words_of_every_length_match_the_library(library, vocabulary, length):
    draw = random.Random(length)
    for letters in ("a", "abc", "abcdefghijklmnopqrstuvwxyz"):
        word = "".join(draw.choice(letters) for _ in range(length))
        assert vocabulary.encode([word])[0].tolist() == library.encode(word, add_special_tokens=False).ids


def test_the_root_is_the_leftmost_pair_of_lowest_rank():
    # 1 = a, 2 = b, 3 = aa, 4 = ab, 5 = aaaa
    merges = {(1, 1): (0, 3), (1, 2): (1, 4), (3, 3): (2, 5)}
    assert byte_pairs.merged([1, 1, 1], merges) == [3, 1]
    assert byte_pairs.merged([1, 1, 1, 2], merges) == [3, 4]
    assert byte_pairs.merged([1] * 5, merges) == [5, 1]
    assert byte_pairs.merged([2], merges) == [2] and byte_pairs.merged([], merges) == []


def test_the_memory_of_words_is_bounded(vocabulary, library, monkeypatch):
    monkeypatch.setattr(byte_pairs, "CACHE", 50)
    texts = [f"w{i} word{i % 7} x{i * 13}" for i in range(400)]
    got = [ids.tolist() for at in range(0, 400, 20) for ids in vocabulary.encode(texts[at : at + 20])]
    assert got == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert len(vocabulary.known) <= 200


def test_runs_of_several_parts_are_cut_and_merged_once(vocabulary, library, monkeypatch):
    fresh, merged = Vocabulary(vocabulary.content), []
    monkeypatch.setattr(fresh, "learn", lambda words: merged.extend(words) or Vocabulary.learn(fresh, words))
    parts = [["one two, two", "", "two <|endoftext|>three"], ["one\u2003three"], ["two,", " "]]
    got = [text.tolist() for ids, ends in fresh.flat(parts) for text in np.split(ids, ends[1:-1])]
    texts = [text for part in parts for text in part]
    assert got == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert sorted(merged) == [",", "one", "three", "two"]


def test_a_worker_builds_the_vocabulary_once(vocabulary):
    same = "".join([vocabulary.content, ""])
    assert byte_pairs.vocabulary_of(vocabulary.content) is byte_pairs.vocabulary_of(same)


def test_marks_between_runs_are_not_taken_from_texts(library, vocabulary):
    texts = ["\n49407", "a\t49407\n5 \t'll\n", "\u0378\t12\n49407 don't\x1cx", "\n<|endoftext|>\n49406\t\u0378"]
    expected = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [ids.tolist() for ids in vocabulary.encode(texts)] == expected
    assert vocabulary.encode([]) == [] and vocabulary.encode([""])[0].tolist() == []


def test_white_space_of_any_length_is_one_blank(vocabulary):
    assert vocabulary.line(" \n" * 100_000 + "A\u2003\u2003b" + "\t" * 100_000) == " a b "
    assert [ids.tolist() for ids in vocabulary.encode([" \n" * 100_000, ""])] == [[], []]


def test_marks_newer_than_the_library_are_not_put_in_order(library, vocabulary):
    texts = ["a\u0354\U00011d45 b", "\U00011935\U00011930", "x\u0345\u08d3 don't", "a\u0345\u0301"]
    expected = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [ids.tolist() for ids in vocabulary.encode(texts)] == expected


def test_rows_of_every_kind(spark, library, monkeypatch):
    monkeypatch.setattr(byte_pairs, "FLUSH", 100)  # several parts to a batch
    rows = [(1, "Hello <|endoftext|> World's"), (1, "Hello <|endoftext|> World's"), (None, "x"), (2, None), (3, ""), (4, " \n")]
    rows += [(10 + i, f"text {i} " * (i % 9)) for i in range(40)] + [(99, "long " * 30_000 + "z" * 3_000)]
    docs = spark.createDataFrame([(i, t, 0, "y") for i, t in rows], "doc_id long, text string, ids int, decoded string")
    got = decoded(encoded(docs.coalesce(1), PATH), PATH)
    assert got.columns == ["doc_id", "ids", "decoded"]
    expected = []
    for i, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        expected.append((i, ids, library.decode(ids, skip_special_tokens=False)))
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, expected))
    assert encoded(docs.limit(0), PATH).count() == 0


def test_decoding_ignores_ids_without_a_token(spark):
    rows = spark.createDataFrame([(1, [0, -1, 1, 70_000]), (2, None), (3, [49407])], "doc_id long, ids array<int>")
    assert {r.doc_id: r.decoded for r in decoded(rows, PATH).collect()} == {1: "! \"", 2: "", 3: "<|endoftext|>"}


def test_the_query_gives_the_digests_of_the_library(spark, library):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    expected = {}
    for row in docs:
        ids = library.encode(row.text or "", add_special_tokens=False).ids
        joined, text = " ".join(map(str, ids)), library.decode(ids, skip_special_tokens=False)
        expected[row.doc_id] = (len(ids), hashlib.sha256(joined.encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
    got = {r.doc_id: tuple(r)[1:] for r in queries.QUERIES["op11_byte_pairs"](spark, sf_dir).collect()}
    assert got == expected
