"""Byte-pair encoding and decoding with a public vocabulary file.

The file is a `tokenizers` JSON of the word-ending kind: NFC, lower case, split
into contractions, runs of letters, single digits and runs of other marks, bytes
as printable characters, `</w>` on the last. Its path is a parameter; every
executor reads the file by itself.

A word is merged over a contiguous array: its parts, and beside each part the
rank of joining it with the next. The array is scanned for the smallest rank, the
boundary is deleted and the ranks of the two neighbours are refreshed; the short
words of a batch lie in one array, and a round does this in each of them. Above
`SCAN_PARTS` parts the same merges are taken from a heap, since scans grow with
the square of a word's length.

White space never reaches a token, so a text is a run of chunks between ASCII
white space. A batch of texts is cut at once into units: ASCII words, and what lies
around apostrophes and characters beyond ASCII. Each different unit is encoded once,
and the ids are gathered. Units that are no ASCII words are lower-cased and split by the
library's own rules for the file, since its Unicode tables are not Python's. Recent
units are remembered per Python worker, up to `REMEMBERED_BYTES`.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.arrays import LOWER_ASCII, SPACES, Words, text_runs, tidy
from millrace.llm.frames import schema_with, without

SCAN_PARTS = 64
REMEMBERED_BYTES = 24 << 20
# Longer chunks are encoded anew each time.
LONGEST_REMEMBERED = 64
# What an entry takes beside its key and value.
_ENTRY_BYTES = 200
_RUN_BYTES = 1 << 20
_NEVER = 1 << 60
# Kinds of bytes: letters, digits and other marks of ASCII each make words of their
# own; next to an apostrophe or a byte beyond ASCII there is no certain end of a word.
_DIGIT, _SPLIT = 2, 4
_KINDS = np.full(256, 3, dtype=np.uint8)
_KINDS[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = 1
_KINDS[0x30:0x3A] = _DIGIT
_KINDS[[0x27, *range(0x80, 0x100)]] = _SPLIT
# The split pattern of the vocabulary, for ASCII.
_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+", re.ASCII)
_SPACE = re.compile(r"\s")


def byte_characters() -> list[str]:
    """The printable character that stands for each byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    stand_in = iter(range(0x100, 0x200))
    known = set(plain)
    return [chr(b) if b in known else chr(next(stand_in)) for b in range(256)]


class Merges:
    """Ids of words by the ranks of a vocabulary file."""

    def __init__(self, model: dict):
        vocab = model["vocab"]
        chars = byte_characters()
        end = model.get("end_of_word_suffix") or ""
        self.inner = [vocab[c] for c in chars]
        self.last = [vocab[c + end] for c in chars]
        # A pair's rank in the high bits, what it becomes in the low 20.
        self.joins: dict[tuple[int, int], int] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.joins[vocab[a], vocab[b]] = rank << 20 | vocab[a + b]
        keys = np.array([a << 20 | b for a, b in self.joins], dtype=np.int64)
        order = np.argsort(keys)
        self._pairs, self._ranks = keys[order], np.array(list(self.joins.values()), dtype=np.int64)[order]

    def words(self, words: Sequence[str]) -> list[bytes]:
        """Ids of words as little-endian unsigned 32-bit integers."""
        spelt = [w.encode() for w in words]
        short = [i for i, w in enumerate(spelt) if len(w) <= SCAN_PARTS]
        out: list[bytes] = [b""] * len(spelt)
        for i, ids in zip(short, self._scan([spelt[i] for i in short])):
            out[i] = ids
        for i, data in enumerate(spelt):
            if len(data) > SCAN_PARTS:
                parts = [*[self.inner[b] for b in data[:-1]], self.last[data[-1]]]
                out[i] = np.array(self._heap(parts), dtype="<u4").tobytes()
        return out

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 20 | right
        at = np.minimum(np.searchsorted(self._pairs, key), len(self._pairs) - 1)
        return np.where(self._pairs[at] == key, self._ranks[at], _NEVER)

    def _scan(self, words: list[bytes]) -> list[bytes]:
        """All short words side by side in one array, one merge each a round."""
        if not words:
            return []
        data = np.frombuffer(b"".join(words), dtype=np.uint8)
        sizes = np.array([len(w) for w in words])
        word = np.repeat(np.arange(len(words)), sizes)
        parts = np.array(self.inner, dtype=np.int64)[data]
        ends = np.cumsum(sizes) - 1
        parts[ends] = np.array(self.last, dtype=np.int64)[data[ends]]
        ranks = np.full(len(parts), _NEVER)  # of joining a part with the next
        inside = np.flatnonzero(word[:-1] == word[1:])
        ranks[inside] = self._rank(parts[inside], parts[inside + 1])
        done = []
        while len(parts):
            first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            count = np.diff(np.r_[first, len(word)])
            best = np.repeat(np.minimum.reduceat(ranks, first), count)
            finished = best == _NEVER
            if finished.any():
                done.append((word[finished], parts[finished]))
                parts, word, ranks, best = (x[~finished] for x in (parts, word, ranks, best))
                continue
            at = np.flatnonzero(ranks == best)
            at = at[np.r_[True, word[at][1:] != word[at][:-1]]]  # the leftmost of equal ranks
            parts[at] = ranks[at] & 0xFFFFF
            keep = np.ones(len(parts), dtype=bool)
            keep[at + 1] = False
            parts, word, ranks = parts[keep], word[keep], ranks[keep]
            at -= np.arange(len(at))  # one part fewer for each word before
            ranks[at] = _NEVER
            last = np.r_[word[1:] != word[:-1], True]
            for near in (at[~last[at]], at[np.r_[True, word[1:] != word[:-1]][at] == 0] - 1):
                ranks[near] = self._rank(parts[near], parts[near + 1])
        word, parts = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(word, kind="stable")
        body = parts[order].astype("<u4").tobytes()
        cuts = [0, *(4 * np.cumsum(np.bincount(word, minlength=len(words)))).tolist()]
        return [body[a:b] for a, b in zip(cuts, cuts[1:])]

    def _heap(self, parts: list[int]) -> list[int]:
        join, n = self.joins.get, len(parts)
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        heap = [(r, i, i + 1) for i in range(n - 1) if (r := join((parts[i], parts[i + 1]), _NEVER)) != _NEVER]
        heapq.heapify(heap)
        while heap:
            rank, i, j = heapq.heappop(heap)
            if after[i] != j or parts[i] < 0 or join((parts[i], parts[j]), _NEVER) != rank:
                continue
            parts[i], parts[j] = rank & 0xFFFFF, -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b >= 0 and (r := join((parts[a], parts[b]), _NEVER)) != _NEVER:
                    heapq.heappush(heap, (r, a, b))
        return [p for p in parts if p >= 0]


class Remembered:
    """What a function of many strings gave for recent ones, in two generations: when
    the young one is full it becomes the old one, and what is not asked for again
    is gone the next time."""

    def __init__(self, of: Callable[[list[str]], list[bytes]], most_bytes: int = REMEMBERED_BYTES):
        self.of, self.young, self.old, self.size, self.most_bytes = of, {}, {}, 0, most_bytes

    def __call__(self, many: list[str]) -> list[bytes]:
        young, old = self.young, self.old
        found = list(map(young.get, many))
        missed = [i for i, ids in enumerate(found) if ids is None]
        new = []
        for i in missed:
            found[i] = ids = old.get(many[i])
            if ids is None:
                new.append(i)
        for i, ids in zip(new, self.of([many[i] for i in new]) if new else ()):
            found[i] = ids
        for i in missed:
            key = many[i]
            if len(key) <= LONGEST_REMEMBERED:
                young[key] = ids = found[i]
                self.size += len(key) + len(ids) + _ENTRY_BYTES
        if self.size > self.most_bytes // 2:
            self.young, self.old, self.size = {}, young, 0
        return found


class Splitter:
    """Chunks to the words that are merged."""

    def __init__(self, file: dict):
        from tokenizers import Tokenizer

        # The library's rules for this file, without its vocabulary.
        rules = {**file, "added_tokens": [], "model": {**file["model"], "vocab": {}, "merges": []}}
        library = Tokenizer.from_str(json.dumps(rules))
        self.normalize = library.normalizer.normalize_str
        self.split = library.pre_tokenizer.pre_tokenize_str
        self.bytes = {ord(c): b for b, c in enumerate(byte_characters())}

    def _spelt(self, shown: str) -> str:
        if shown.isascii():  # printable, so each stands for itself
            return shown
        return shown.translate(self.bytes).encode("latin-1").decode()

    def _beyond_ascii(self, chunks: list[str]) -> list[list[str]]:
        joined = self.normalize(" ".join(chunks))
        if joined.count(" ") != len(chunks) - 1:  # white space beyond ASCII in a chunk
            half = len(chunks) // 2
            if half:
                return self._beyond_ascii(chunks[:half]) + self._beyond_ascii(chunks[half:])
            return [[self._spelt(shown) for shown, _ in self.split(joined)]]
        ends = np.cumsum([len(c) + 1 for c in joined.split(" ")])
        words = self.split(joined)
        owner = np.searchsorted(ends, [start for _, (start, _) in words], side="right").tolist()
        out: list[list[str]] = [[] for _ in chunks]
        for i, (shown, _) in zip(owner, words):
            out[i].append(self._spelt(shown))
        return out

    def __call__(self, many: list[str]) -> list[list[str]]:
        find = _PIECES.findall
        out = [find(c.lower()) if c.isascii() else None for c in many]
        other = [i for i, words in enumerate(out) if words is None]
        # White space beyond ASCII would shift the chunks of a part against each other.
        spaced = {i for i in other if _SPACE.search(many[i])}
        for i in spaced:
            out[i] = [self._spelt(shown) for shown, _ in self.split(self.normalize(many[i]))]
        other = [i for i in other if i not in spaced]
        for at in range(0, len(other), 1000):
            part = other[at : at + 1000]
            for i, words in zip(part, self._beyond_ascii([many[i] for i in part])):
                out[i] = words
        return out


def by_words(split: Splitter, words: Callable[[list[str]], list[bytes]]) -> Callable[[list[str]], list[bytes]]:
    """Ids of units: ASCII words, or chunks that have to be split first. Each
    different word is merged once."""

    def units(many: list[str]) -> list[bytes]:
        whole = [i for i, unit in enumerate(many) if not unit.isascii() or "'" in unit]
        pieces = split([many[i] for i in whole])
        different = dict.fromkeys(many)
        for i in whole:
            different.pop(many[i], None)
        different = list(different | dict.fromkeys(w for own in pieces for w in own))
        ids = dict(zip(different, words(different)))
        out = [ids.get(unit, b"") for unit in many]
        for i, own in zip(whole, pieces):
            out[i] = b"".join([ids[w] for w in own])
        return out

    return units


class Encoder:
    """Whole texts to ids, given a function from units to ids as bytes (little-endian
    unsigned 32-bit integers). Strings of special tokens inside a text become those
    tokens."""

    def __init__(self, special: dict[str, int], units: Callable[[list[str]], list[bytes]], run_bytes: int = _RUN_BYTES):
        self.run_bytes = run_bytes
        self.special = {name: np.array([i], "<u4") for name, i in special.items()}
        names = sorted(special, key=len, reverse=True)
        self.marker = re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None
        self.units = units

    def _plain(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ends by text) of texts without special tokens."""
        run = Words(data, offsets)
        lengths = run.ends - run.starts
        chunk = np.r_[0, np.cumsum(lengths)]
        body = data[~SPACES[data]]
        kind = _KINDS[body]
        odd = kind == _SPLIT
        begins = np.ones(len(body), dtype=bool)
        begins[1:] = ((kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)) & ~odd[1:] & ~odd[:-1]
        begins[chunk[:-1]] = True
        unit = np.flatnonzero(begins)
        if len(unit):
            whole = np.repeat(np.logical_or.reduceat(odd, unit), np.diff(np.r_[unit, len(body)]))
            body = np.where(whole, body, LOWER_ASCII[body])
        at = np.r_[unit, len(body)].astype(np.int64)
        units = pa.LargeStringArray.from_buffers(len(unit), pa.py_buffer(at), pa.py_buffer(body)).dictionary_encode()
        # By way of numpy, which makes all strings in one call of Arrow.
        known = self.units(units.dictionary.to_numpy(zero_copy_only=False).tolist())
        ids = np.frombuffer(b"".join(known), "<u4")
        sizes = np.array([len(k) for k in known], dtype=np.int64) // 4
        code = np.asarray(units.indices)
        each = sizes[code]
        upto = np.cumsum(each)
        first = (np.cumsum(sizes) - sizes)[code] - (upto - each)
        gathered = ids[np.repeat(first, each) + np.arange(len(each) and upto[-1])]
        return gathered, np.r_[0, upto][np.searchsorted(unit, chunk[run.first[1:]])]

    def _marked(self, text: str) -> np.ndarray:
        parts = [np.zeros(0, "<u4")]
        for piece in self.marker.split(text):
            if piece in self.special:
                parts.append(self.special[piece])
            elif piece:
                data = np.frombuffer(piece.encode(), dtype=np.uint8)
                parts.append(self._plain(data, np.array([0, len(data)]))[0])
        return np.concatenate(parts)

    def __call__(self, texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(first row, end row, ids, offsets) of runs of texts. NULLs are empty."""
        marked = np.zeros(len(texts), dtype=bool)
        for name in self.special:
            marked |= np.asarray(pc.fill_null(pc.match_substring(texts, name), False))
        cuts = np.unique(np.r_[0, len(texts), np.flatnonzero(marked), np.flatnonzero(marked) + 1])
        for low, high in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            if marked[low]:
                ids = self._marked(texts[low].as_py())
                yield low, high, ids, np.array([0, len(ids)])
                continue
            for row, end, data, offsets in text_runs(texts.slice(low, high - low), self.run_bytes):
                ids, ends = self._plain(data, offsets)
                yield low + row, low + end, ids, np.r_[0, ends]


def read_file(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def special_tokens(file: dict) -> dict[str, int]:
    return {t["content"]: t["id"] for t in file["added_tokens"]}


@lru_cache(maxsize=2)
def merge_encoder(path: str) -> Encoder:
    file = read_file(path)
    return Encoder(special_tokens(file), Remembered(by_words(Splitter(file), Merges(file["model"]).words)))


@lru_cache(maxsize=2)
def token_strings(path: str) -> pa.Array:
    file = read_file(path)
    names = {i: t for t, i in file["model"]["vocab"].items()} | {i: t for t, i in special_tokens(file).items()}
    return pa.array([names.get(i, "") for i in range(max(names) + 1)], pa.large_string())


def encode(docs: DataFrame, tokenizer_path: str, text: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """Adds `ids` to `docs`: the whole text's token ids as binary, little-endian
    unsigned 32-bit integers. NULL and empty texts have no ids. All rows stay; a
    column `ids` is replaced; `keep` names the columns to return beside it, by
    default all."""
    from pyspark.sql.pandas.types import to_arrow_schema

    docs = without(docs, ("ids",))
    kept = docs.columns if keep is None else list(keep)
    out = schema_with(docs.select(*[F.col(f"`{c}`") for c in kept]), "ids binary")
    schema = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = merge_encoder(tokenizer_path)
        for batch in batches:
            for row, end, ids, offsets in encoder(batch[text]):
                column = pa.Array.from_buffers(
                    pa.binary(), end - row, [None, pa.py_buffer((offsets * 4).astype(np.int32)), pa.py_buffer(ids.astype("<u4", copy=False))]
                )
                rest = [batch[f.name].slice(row, end - row).cast(f.type) for f in list(schema)[:-1]]
                yield pa.RecordBatch.from_arrays([*rest, column], schema=schema)

    return docs.mapInArrow(tidy(run), out)


def decode(rows: DataFrame, tokenizer_path: str) -> DataFrame:
    """Adds `decoded` to rows with `ids`: the tokens' strings joined by a space,
    which is how this kind of file decodes, special tokens included. NULL ids
    decode to an empty text."""
    from pyspark.sql.pandas.types import to_arrow_schema

    rows = without(rows, ("decoded",))
    out = schema_with(rows, "decoded string")
    schema = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        strings = token_strings(tokenizer_path)
        for batch in batches:
            for part in (batch.slice(i, 200) for i in range(0, batch.num_rows, 200)):
                ids = part["ids"].to_pylist()
                ends = np.cumsum([0] + [len(b or b"") // 4 for b in ids])
                tokens = strings.take(pa.array(np.frombuffer(b"".join(b or b"" for b in ids), "<u4")))
                lists = pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), tokens)
                texts = pc.binary_join(lists, pa.scalar(" ", pa.large_string())).cast(pa.string())
                yield pa.RecordBatch.from_arrays([*[c.cast(f.type) for c, f in zip(part.columns, schema)], texts], schema=schema)

    return rows.mapInArrow(tidy(run), out)
