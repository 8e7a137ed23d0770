"""Encoding and decoding by byte pairs, with a segment tree over the ranks of adjacent pairs.

A word starts as one symbol per byte, the last one marked as the end of the word. The leaves
of a segment tree hold, for every adjacent pair of symbols, its merge rank and place, and every
node holds the least of its two children, so the root is the leftmost pair of lowest rank. A
merge changes three leaves and their ancestors; it goes on until the root has no rank left. A
word of n bytes costs n log n however long it is.

The rules around the merges are those of the vocabulary file: special tokens are cut out of the
raw text; the rest is composed (NFC), runs of white space become one space, letters become small
one by one, and words are found by a fixed pattern. Texts with code points that Python's Unicode
tables do not know yet, or compose and order otherwise than the tokenizers library, whose tables
are older, are left to the file's own normaliser and splitter.

As no word holds white space, texts are split there first. Arrow tells their runs apart over many
texts at once; a distinct run is cut into words once, and a distinct word merged once.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

CACHE = 400_000  # words that a worker remembers beyond those of the batch at hand
FLUSH = 1 << 20  # bytes, or ids, that a task works on at once; a longer text comes alone
SPAN = 1 << 22  # bytes of texts of which the words are told apart at once
SHORT = 64  # words of up to so many bytes are merged many at once, and remembered
TOGETHER = 1 << 16  # leaves of the trees that are merged at once
NONE = 1 << 62  # a leaf without a merge

# Fixed value: how the vocabulary file cuts words.
PATTERN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")

# All that the pattern takes for white space, of which no word holds any. A line has only blanks
# of it left between its runs, so that two others can mark runs that are not cut any more.
SPACES = [chr(c) for c in range(0x3001) if regex.match(r"\s", chr(c))]
BLANKS = regex.compile("  +")
SPECIAL, WORD = "\n", "\t"  # before the id of a special token; before a word that the file has cut
CUT = regex.compile(rf"{SPECIAL}[0-9]+|{WORD}[^ ]+|{PATTERN.pattern}| ")


def byte_signs() -> list[str]:
    """The printable character that stands for each byte: itself, or the next one from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in plain else next(spare)) for b in range(256)]


def merged(symbols: list[int], merges: dict[tuple[int, int], tuple[int, int]]) -> list[int]:
    """Apply merges to a word, the lowest rank first and the leftmost of equal ones."""
    n = len(symbols)
    if n < 2:
        return symbols
    symbols = list(symbols)
    width = 1 << (n - 2).bit_length() if n > 2 else 1
    tree = [NONE] * (2 * width)
    for i in range(n - 1):
        found = merges.get((symbols[i], symbols[i + 1]))
        if found is not None:
            tree[width + i] = found[0] << 32 | i
    for node in range(width - 1, 0, -1):
        left, right = tree[2 * node], tree[2 * node + 1]
        tree[node] = left if left < right else right

    def put(place: int, key: int) -> None:
        node = width + place
        tree[node] = key
        while node > 1:
            node >>= 1
            left, right = tree[2 * node], tree[2 * node + 1]
            least = left if left < right else right
            if tree[node] == least:
                break
            tree[node] = least

    after = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    while tree[1] < NONE:
        at = tree[1] & 0xFFFFFFFF
        gone = after[at]
        symbols[at] = merges[symbols[at], symbols[gone]][1]
        symbols[gone] = -1
        follows = after[gone]
        after[at] = follows
        if gone < n - 1:
            put(gone, NONE)
        found = None
        if follows < n:
            before[follows] = at
            found = merges.get((symbols[at], symbols[follows]))
        put(at, NONE if found is None else found[0] << 32 | at)
        previous = before[at]
        if previous >= 0:
            found = merges.get((symbols[previous], symbols[at]))
            put(previous, NONE if found is None else found[0] << 32 | previous)
    return [s for s in symbols if s >= 0]


class Vocabulary:
    """The tokens and merges of one vocabulary file, and the words merged so far."""

    def __init__(self, content: str):
        held = json.loads(content)
        model = held["model"]
        suffix, ids = model["end_of_word_suffix"], model["vocab"]
        self.content = content
        self.merges = {}
        for rank, (a, b) in enumerate(m if isinstance(m, list) else m.split(" ") for m in model["merges"]):
            self.merges[ids[a], ids[b]] = (rank, ids[a + b])
        table = np.array([(a << 32 | b, rank, new) for (a, b), (rank, new) in self.merges.items()], dtype=np.int64)
        table = table.reshape(-1, 3)[np.argsort(table.reshape(-1, 3)[:, 0])]
        self.pairs = np.append(table[:, 0], NONE)
        self.keys = np.append(table[:, 1] << 42 | table[:, 2] << 21, NONE)
        signs = byte_signs()
        self.inner = np.array([ids.get(s, -1) for s in signs], dtype=np.int64)
        self.last = np.array([ids.get(s + suffix, -1) for s in signs], dtype=np.int64)
        self.special = {t["content"]: t["id"] for t in held["added_tokens"]}
        longest = sorted(self.special, key=len, reverse=True)
        self.cut = regex.compile("|".join(map(regex.escape, longest))) if longest else None
        self.seen = {chr(c) for c in range(128)}  # characters that Python's tables know
        self.known: dict[str, bytes] = {}  # the ids of words, four bytes each
        self.fixed = {" ": b""} | {f"{SPECIAL}{i}": np.int32(i).tobytes() for i in self.special.values()}
        self._file = None

    def learn(self, words: list[str]) -> dict[str, bytes]:
        """Merge words, the short ones of one width together."""
        out = {}
        coded = [w.removeprefix(WORD).encode() for w in words]
        sizes = np.fromiter(map(len, coded), dtype=np.int64, count=len(coded))
        widths = np.left_shift(1, np.maximum(1, np.ceil(np.log2(np.maximum(sizes, 1))).astype(np.int64)))
        for width in np.unique(widths).tolist():
            group = np.flatnonzero(widths == width)
            step = TOGETHER // width if width <= SHORT else 1
            for at in range(0, len(group), step):
                part = group[at : at + step]
                data = np.frombuffer(b"".join([coded[i] for i in part]), dtype=np.uint8)
                ends = np.cumsum(sizes[part])
                symbols = self.inner[data]
                symbols[ends - 1] = self.last[data[ends - 1]]
                lacking = symbols < 0  # bytes that the vocabulary lacks are left out
                held = np.diff(np.concatenate([[0], np.cumsum(~lacking)])[np.append(0, ends)])
                symbols = symbols[~lacking]
                if width > SHORT:
                    out[words[part[0]]] = np.array(merged(symbols.tolist(), self.merges), dtype=np.int32).tobytes()
                    continue
                found = self.merged_together(symbols, held, width)
                left = found >= 0
                stops = np.cumsum(left.sum(1) * 4).tolist()
                ids = found[left].astype(np.int32).tobytes()
                for i, start, stop in zip(part.tolist(), [0, *stops[:-1]], stops, strict=True):
                    out[words[i]] = ids[start:stop]
        return out

    def merged_together(self, flat: np.ndarray, sizes: np.ndarray, width: int) -> np.ndarray:
        """What ``merged`` does, for many words at once: one row of the arrays is one tree.

        ``flat`` holds the symbols of all words; a row of the result holds those of one, and -1.
        """
        n, across = len(sizes), width + 1
        symbols = np.full((n, across), -1, dtype=np.int64)
        symbols[np.arange(across) < sizes[:, None]] = flat

        def keys(left: np.ndarray, right: np.ndarray, place: np.ndarray) -> np.ndarray:
            pair = np.where((left < 0) | (right < 0), NONE - 1, left << 32 | right)
            found = np.searchsorted(self.pairs, pair)
            return np.where(self.pairs[found] == pair, self.keys[found] + place, NONE)

        tree = np.full((n, 2 * width), NONE, dtype=np.int64)
        tree[:, width:] = keys(symbols[:, :-1], symbols[:, 1:], np.arange(width))
        half = width // 2
        while half:
            tree[:, half : 2 * half] = np.minimum(tree[:, 2 * half : 4 * half : 2], tree[:, 2 * half + 1 : 4 * half : 2])
            half //= 2
        # From here on all rows lie in one line each, and cells are named by their place in it.
        tree, held = tree.reshape(-1), symbols.reshape(-1)
        after = np.tile(np.arange(1, width + 2), n)
        before = np.tile(np.arange(-1, width), n)
        row = np.arange(n)
        while True:
            root = tree[row * (2 * width) + 1]
            going = root < NONE
            row, root = row[going], root[going]
            if not len(row):
                return symbols
            line, top = row * across, row * (2 * width)
            at, new = root & 0x1FFFFF, root >> 21 & 0x1FFFFF
            here = line + at
            gone = after[here]
            held[here] = new
            held[line + gone] = -1
            follows = after[line + gone]
            after[here] = follows
            next_to = line + np.minimum(follows, width)
            before[next_to] = at
            previous = before[here]
            first = previous < 0
            place = np.where(first, at, previous)
            key = keys(new, held[next_to], at)
            leaves = top + width
            tree[leaves + np.minimum(gone, width - 1)] = NONE
            tree[leaves + at] = key
            tree[leaves + place] = np.where(first, key, keys(held[line + place], new, place))
            node, tops = np.concatenate([at, gone, place]) + width, np.tile(top, 3)
            for _ in range(width.bit_length() - 1):
                node >>= 1
                pair = tops + 2 * node
                tree[tops + node] = np.minimum(tree[pair], tree[pair + 1])

    def line(self, text: str) -> str:
        """A text without special tokens as runs with blanks between; no word reaches over a blank."""
        if not text.isascii():
            for sign in set(text) - self.seen:
                if unicodedata.category(sign) == "Cn" or sign >= "\u0300" and sign in composed_otherwise():
                    return self._by_file(text)
                self.seen.add(sign)
            text = unicodedata.normalize("NFC", text)
        # A capital sigma is the one letter that str.lower treats by its place in the word.
        text = "".join(map(str.lower, text)) if "Σ" in text else text.lower()
        for space in SPACES:
            if space in text:
                text = text.replace(space, " ")
        return BLANKS.sub(" ", text) if "  " in text else text

    def _by_file(self, text: str) -> str:
        if self._file is None:
            from tokenizers import Tokenizer

            self._file = Tokenizer.from_str(self.content)
        text = self._file.normalizer.normalize_str(text)
        return " ".join(WORD + text[a:b] for _, (a, b) in self._file.pre_tokenizer.pre_tokenize_str(text))

    def marked(self, text: str) -> str:
        """A text as runs with blanks between; special tokens are runs of their own."""
        out: list[str] = []
        at = 0
        for met in self.cut.finditer(text) if self.cut else ():
            out += [self.line(text[at : met.start()]), f"{SPECIAL}{self.special[met.group()]}"]
            at = met.end()
        if not out:
            return self.line(text)
        return " ".join([*out, self.line(text[at:])])

    def known_ids(self, words: list[str]) -> list[bytes]:
        """The ids of each of some distinct words."""
        found = list(map(self.known.get, words))
        lacking = [i for i, ids in enumerate(found) if ids is None]
        if len(self.known) + len(lacking) > CACHE:
            self.known = {w: ids for w, ids in zip(words, found, strict=True) if ids is not None}
        new = self.learn([w for w in map(words.__getitem__, lacking) if w not in self.fixed])
        self.known |= new
        for long in [w for w in new if len(w) > SHORT]:
            del self.known[long]
        new |= self.fixed
        for i in lacking:
            found[i] = new[words[i]]
        return found

    def flat(self, parts: list[list[str]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each part, the ids of its texts one after the other, and where each text's begin and end.

        Runs that the parts have in common are cut once, and words that runs have in common merged once.
        """
        lines = [pc.split_pattern(pa.array(map(self.marked, texts), pa.large_string()), " ") for texts in parts]
        runs = pa.chunked_array([line.flatten().dictionary_encode() for line in lines]).unify_dictionaries()
        words = pa.array(CUT.findall(" ".join(runs.chunk(0).dictionary.to_pylist())), pa.large_string())
        blanks = np.flatnonzero(pc.equal(words, " ").to_numpy(zero_copy_only=False))
        words = words.dictionary_encode()
        found = self.known_ids(words.dictionary.to_pylist())
        sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found)) // 4
        ids, ends = _taken(np.frombuffer(b"".join(found), dtype=np.int32), sizes, words.indices.to_numpy())
        sizes = np.diff(ends[np.concatenate([[0], blanks, [len(words)]])])
        for line, met in zip(lines, runs.chunks, strict=True):
            out, ends = _taken(ids, sizes, met.indices.to_numpy())
            yield out, ends[line.offsets.to_numpy()]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of every text; special tokens in it become their ids."""
        return [part for ids, ends in self.flat([texts]) for part in np.split(ids, ends[1:-1])] if texts else []


def _taken(held: np.ndarray, sizes: np.ndarray, met: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Items of ``held``, of which ``sizes`` are the sizes, in the order ``met``; and where each begins and ends."""
    taken = sizes[met]
    ends = np.concatenate([[0], np.cumsum(taken)])
    places = np.repeat((np.cumsum(sizes) - sizes)[met] - ends[:-1], taken)
    places += np.arange(len(places))
    return held[places], ends


@lru_cache(maxsize=1)
def composed_otherwise() -> frozenset[str]:
    """Signs that Python composes, or orders among other marks, and the tokenizers library does not, or the reverse."""
    from tokenizers import normalizers

    probes = []
    for sign in map(chr, range(0x300, 0x110000)):
        apart = unicodedata.normalize("NFD", sign) if unicodedata.decomposition(sign)[:1] not in ("", "<") else sign
        if apart != sign:
            probes.append((sign + apart, apart))
        if unicodedata.combining(sign):
            probes.append((sign, "\u0345" + sign))  # a mark of the highest class
    theirs = normalizers.NFC().normalize_str(" ".join(probe for _, probe in probes)).split(" ")
    mine = [unicodedata.normalize("NFC", probe) for _, probe in probes]
    return frozenset("".join(signs for (signs, _), a, b in zip(probes, mine, theirs, strict=True) if a != b))


@lru_cache(maxsize=1)
def vocabulary_of(content: str) -> Vocabulary:
    """The vocabulary of a file, built once in a worker and kept for its next tasks."""
    return Vocabulary(content)


@lru_cache(maxsize=1)
def tokens_of(content: str) -> pa.Array:
    """The token of every id, null where the file has none."""
    held = json.loads(content)
    names = {i: t for t, i in held["model"]["vocab"].items()} | {t["id"]: t["content"] for t in held["added_tokens"]}
    return pa.array([names.get(i) for i in range(max(names) + 1)], pa.string())


def _parts(sizes: np.ndarray, bound: int) -> Iterator[tuple[int, int]]:
    """Cut the rows of a batch, of which ``sizes`` are the running sizes, into bounded parts."""
    start = 0
    while start < len(sizes) - 1:
        stop = max(start + 1, int(np.searchsorted(sizes, sizes[start] + bound, side="right")) - 1)
        yield start, stop
        start = stop


def _shaped(docs: DataFrame, *added: StructField) -> StructType:
    return StructType([docs.schema["doc_id"], *added])


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids`` for every row of ``docs(doc_id, text)``, by the vocabulary file at ``path``.

    The file is read on the driver and sent to the tasks. A null text counts as empty and an
    empty one has no ids. Rows that repeat are each encoded; a null ``doc_id`` stays null; other
    columns, also ones called ``ids``, are ignored. No text is cut short, and a word of any
    length is merged as a whole.
    """
    with open(path, encoding="utf-8") as file:
        content = docs.sparkSession.sparkContext.broadcast(file.read())
    schema = _shaped(docs, StructField("ids", ArrayType(IntegerType())))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = vocabulary_of(content.value)
        for batch in batches:
            sizes = np.cumsum([0, *pc.fill_null(pc.binary_length(batch.column(1)), 0).to_pylist()])
            for first, last in _parts(sizes, SPAN):
                places = [(first + a, first + b) for a, b in _parts(sizes[first : last + 1], FLUSH)]
                parts = [[t or "" for t in batch.column(1).slice(a, b - a).to_pylist()] for a, b in places]
                for (start, stop), (held, ends) in zip(places, vocabulary.flat(parts), strict=True):
                    ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(held))
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, stop - start), ids], names=["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(encode, schema)


def decoded(rows: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids, decoded`` from ``doc_id, ids``: the tokens' own strings, joined by a space.

    That is what the file prescribes, as it names no decoder. Null ids count as none, ids without
    a token are left out, and no ids give an empty text.
    """
    with open(path, encoding="utf-8") as file:
        content = rows.sparkSession.sparkContext.broadcast(file.read())
    schema = _shaped(rows, StructField("ids", ArrayType(IntegerType())), StructField("decoded", StringType()))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = tokens_of(content.value)
        for batch in batches:
            lists = batch.column(1)
            sizes = np.cumsum([0, *pc.fill_null(pc.list_value_length(lists), 0).to_pylist()])
            for start, stop in _parts(sizes, FLUSH):
                part = lists.slice(start, stop - start)
                ids = part.flatten().to_numpy(zero_copy_only=False)
                lengths = sizes[start : stop + 1] - sizes[start]
                fits = (ids >= 0) & (ids < len(tokens))
                names = tokens.take(pa.array(np.where(fits, ids, 0)))
                kept = fits & names.is_valid().to_numpy(zero_copy_only=False)
                if not kept.all():
                    names = names.filter(pa.array(kept))
                    lengths = np.concatenate([[0], np.cumsum(kept)])[lengths]
                joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(lengths, pa.int32()), names), " ")
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, stop - start), part, joined],
                    names=["doc_id", "ids", "decoded"],
                )

    return rows.select("doc_id", "ids").mapInArrow(decode, schema)
