"""Byte-level BPE by prefix dynamic programming.

For every prefix of a piece of bytes, exactly one token can be the last of its encoding: a suffix of the
prefix that may follow the last token of what is before it. Two tokens may stand side by side if
merging their joined bytes by rank gives those two again. So the encoding of a longer text extends the table, and
an edit leaves the table before it as it is.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from dqspark.llm._arrow import SpanHasher, mix, span_hashes

CACHED_PIECES = 250_000
"""Distinct pieces whose encoding a worker keeps as recent, and as many that were recent before."""
KNOWN_PAIRS = 1 << 20
"""Places for pairs of tokens whose verdict a worker remembers."""
LONG_PIECE = 40
"""Pieces of more bytes are encoded one by one."""
ROWS = 500


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their ranks from a file of base64 words and numbers."""
    with open(path, "rb") as lines:
        return {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, lines)}


class Vocabulary:
    """Token bytes, and the split of each token into the two that its last merge joins."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ids = ranks
        self.bytes = {i: b for b, i in ranks.items()}
        self.lengths = {i: len(b) for b, i in ranks.items()}
        self.longest = max(map(len, ranks))
        # Finds all tokens that end at each byte; it takes bytes as the characters of the same numbers.
        self.finder = ahocorasick.Automaton()
        for word, rank in ranks.items():
            self.finder.add_word(word.decode("latin-1"), rank)
        self.finder.make_automaton()
        self.left = dict.fromkeys(self.bytes, -1)
        self.right = dict.fromkeys(self.bytes, -1)
        for word, rank in ranks.items():
            if len(word) > 1:
                parts = self._merged(word, rank)
                if len(parts) == 2:
                    self.left[rank], self.right[rank] = parts
        self.joined = {(self.left[i], self.right[i]): i for i in self.bytes if self.left[i] >= 0}

    def _merged(self, word: bytes, below: int) -> list[int]:
        """The tokens of ``word`` after all merges of ranks less than ``below``."""
        parts = [word[i : i + 1] for i in range(len(word))]
        while len(parts) > 1:
            ranks = [self.ids.get(parts[i] + parts[i + 1], below) for i in range(len(parts) - 1)]
            best = min(ranks)
            if best >= below:
                break
            i = ranks.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return [self.ids[p] for p in parts]

    def may_follow(self, a: int, b: int) -> bool:
        """Whether merging by rank keeps ``a`` and ``b`` apart.

        Undoes the merges of both from the last one, on the sides that touch: at each moment the two
        touching tokens must not have had a merge of a lower rank than the merge undone.
        """
        below = len(self.bytes) + 1
        while True:
            over = self.joined.get((a, b))
            if over is not None and over < below:
                return False
            # The later merge of the two tokens is undone first; of equal ones the right token's.
            if a > b and self.right[a] >= 0 or self.left[b] < 0:
                if self.right[a] < 0:
                    return True
                below, a = a, self.right[a]
            else:
                below, b = b + 1, self.left[b]


class Prefixes:
    """The last token of every prefix of a piece, from which encodings are read backwards."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data, self.last = vocabulary, b"", []
        self.append(data)

    def append(self, more: bytes) -> None:
        """Extend the piece; the entries of earlier prefixes stay."""
        start, self.data = len(self.data), self.data + more
        self.last += [-1] * len(more)
        self._fill(start, len(self.data))

    def _fill(self, start: int, end: int) -> None:
        """The entries of the prefixes that end in ``[start, end)``, whose places hold -1."""
        last, lengths, may_follow = self.last, self.vocabulary.lengths, self.vocabulary.may_follow
        begin = max(0, start - self.vocabulary.longest + 1)
        for at, token in self.vocabulary.finder.iter(self.data[begin:end].decode("latin-1")):
            at += begin
            if last[at] < 0:
                before = at - lengths[token]
                if before < 0 or may_follow(last[before], token):
                    last[at] = token

    def replace(self, start: int, end: int, by: bytes) -> int:
        """Put ``by`` in place of ``[start, end)``; returns the number of prefixes worked out anew.

        Entries before the edit stay. After it, once as many entries in a row as the longest token has bytes
        are what they were, all later ones are too.
        """
        old, shift = self.last, len(by) - (end - start)
        self.data = self.data[:start] + by + self.data[end:]
        self.last = old[:start] + [-1] * (len(self.data) - start)
        done, same = start, 0
        while done < len(self.data):
            step = min(len(self.data), max(done, start + len(by)) + self.vocabulary.longest)
            self._fill(done, step)
            for at in range(max(done, start + len(by)), step):
                same = same + 1 if self.last[at] == old[at - shift] else 0
            done = step
            if same >= self.vocabulary.longest:
                self.last[done:] = old[done - shift :]
                break
        return done - start

    def ids(self) -> list[int]:
        out, end = [], len(self.data)
        while end:
            out.append(self.last[end - 1])
            end -= len(self.vocabulary.bytes[out[-1]])
        return out[::-1]


class Lookup:
    """Numbers by 64-bit hash for whole arrays: open addressing in one array."""

    def __init__(self, hashes: np.ndarray, values: np.ndarray):
        bits = int(np.ceil(np.log2(max(len(hashes), 2)))) + 2
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.values = np.zeros(1 << bits, np.uint64), np.full(1 << bits, -1, np.int64)
        self.tries = 1
        for h, v in zip(hashes, values, strict=True):
            slot, tries = int(h >> self.shift), 1
            while self.values[slot] >= 0:
                slot, tries = (slot + 1) & self.mask, tries + 1
            self.keys[slot], self.values[slot], self.tries = h, v, max(self.tries, tries)

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        slot = (hashes >> self.shift).astype(np.int64)
        found = np.where(self.keys[slot] == hashes, self.values[slot], -1)
        open_ = np.flatnonzero((found < 0) & (self.values[slot] >= 0))
        for _ in range(1, self.tries):
            if not len(open_):
                break
            at = slot[open_] = (slot[open_] + 1) & self.mask
            hit = self.keys[at] == hashes[open_]
            found[open_[hit]] = self.values[at[hit]]
            open_ = open_[~hit & (self.values[at] >= 0)]
        return found


class PieceBatch:
    """The tables of prefixes of many pieces at once, by array operations: ``Prefixes`` for short pieces."""

    def __init__(self, vocabulary: Vocabulary):
        words = sorted(vocabulary.ids.items(), key=lambda x: x[1])
        ends = np.cumsum([len(w) for w, _ in words])
        data = np.frombuffer(b"".join(w for w, _ in words), np.uint8)
        starts = np.concatenate([[0], ends[:-1]])
        size = max(vocabulary.bytes) + 1
        self.token = Lookup(span_hashes(data, starts, ends), np.array([i for _, i in words]))
        self.left, self.right, self.lengths = (np.full(size, -1, np.int64) for _ in range(3))
        for i, word in vocabulary.bytes.items():
            self.left[i], self.right[i], self.lengths[i] = vocabulary.left[i], vocabulary.right[i], len(word)
        pairs = np.array(list(vocabulary.joined)).reshape(-1, 2)
        self.joined = Lookup(self._pair(pairs[:, 0], pairs[:, 1]), np.array(list(vocabulary.joined.values())))
        self.longest, self.top = vocabulary.longest, size
        self.known, self.verdict = np.zeros(KNOWN_PAIRS, np.uint64), np.zeros(KNOWN_PAIRS, bool)

    @staticmethod
    def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return mix((a.astype(np.uint64) << np.uint64(32)) + b.astype(np.uint64) + np.uint64(1))

    def pairs(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """``may_follow`` of each pair; verdicts are remembered in places that later ones overwrite."""
        keys = self._pair(a, b)
        slot = (keys % np.uint64(KNOWN_PAIRS)).astype(np.int64)
        new = np.flatnonzero(self.known[slot] != keys)
        out = self.verdict[slot]
        if len(new):
            out[new] = self._may_follow(a[new], b[new])
            self.known[slot[new]] = keys[new]
            self.verdict[slot[new]] = out[new]
            # Two new pairs of one place: the place holds the last of both arrays' writes.
        return out

    def _may_follow(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        ok, live, below = np.zeros(len(a), bool), np.arange(len(a)), np.full(len(a), self.top + 1)
        while len(live):
            over = self.joined(self._pair(a, b))
            ra, lb = self.right[a], self.left[b]
            on_a = ((a > b) & (ra >= 0)) | (lb < 0)
            refused = (over >= 0) & (over < below)
            through = ~refused & on_a & (ra < 0)
            ok[live[through]] = True
            stay = ~(refused | through)
            below = np.where(on_a, a, b + 1)[stay]
            a, b, live = np.where(on_a, ra, a)[stay], np.where(on_a, b, lb)[stay], live[stay]
        return ok

    def encode(self, pieces: list[bytes]) -> list[bytes]:
        sizes = np.array([len(p) for p in pieces])
        order = np.argsort(-sizes, kind="stable")
        sizes, data = sizes[order], np.frombuffer(b"".join([pieces[i] for i in order]), np.uint8)
        starts = np.cumsum(sizes) - sizes
        longest = int(sizes[0])
        fits = [int(np.searchsorted(-sizes, -n, "right")) for n in range(longest + 1)]  # pieces of n bytes or more
        last = np.full(len(data), -1, np.int64)
        hashes = SpanHasher(data)
        for end in range(1, longest + 1):
            at = starts[: fits[end]] + end
            todo = np.arange(len(at))
            for begin in range(max(0, end - self.longest), end):
                if not len(todo):
                    break
                stop = at[todo]
                token = self.token(hashes(stop - (end - begin), stop))
                hit = np.flatnonzero(token >= 0)
                if begin:
                    hit = hit[self.pairs(last[stop[hit] - (end - begin) - 1], token[hit])]
                last[stop[hit] - 1] = token[hit]
                todo = np.delete(todo, hit)
        # Backwards from the ends of all pieces, the last token first.
        rows, tokens, live, stop = [], [], np.arange(len(sizes)), starts + sizes
        while len(live):
            token = last[stop[live] - 1]
            rows.append(live)
            tokens.append(token)
            stop[live] -= self.lengths[token]
            live = live[stop[live] > starts[live]]
        rows, tokens = np.concatenate(rows[::-1]), np.concatenate(tokens[::-1])
        by_row = np.argsort(rows, kind="stable")
        packed = tokens[by_row].astype("<u4").tobytes()
        cuts = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=len(sizes)))]) * 4
        out = [b""] * len(pieces)
        for k, i in enumerate(order):
            out[i] = packed[cuts[k] : cuts[k + 1]]
        return out


class Encoder:
    """Encodes texts to ids as little-endian unsigned 32-bit integers."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.vocabulary = Vocabulary(ranks)
        self.batch = PieceBatch(self.vocabulary)
        self.words = self.vocabulary.bytes
        self.recent: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        spaces = r"\p{White_Space}"
        self.any = regex.compile(pattern.replace(r"[^\s", rf"[^{spaces}").replace(r"\S", rf"[^{spaces}]").replace(r"\s", spaces))
        self.ascii = re.compile(ascii_pattern(pattern), re.ASCII)

    def pieces(self, text: str) -> list[str]:
        return (self.ascii if text.isascii() else self.any).findall(text)

    def learn(self, pieces: set[str]) -> None:
        """Bring the encodings of these pieces into ``recent``."""
        new = [p for p in pieces if p not in self.recent]
        if len(self.recent) + len(new) > CACHED_PIECES:
            self.older, self.recent = self.recent, {}
            new = list(pieces)
        short = []
        for piece in new:
            known = self.older.get(piece)
            data = piece.encode() if known is None else b""
            if known is not None:
                self.recent[piece] = known
            elif data in self.vocabulary.ids:
                self.recent[piece] = array("I", [self.vocabulary.ids[data]]).tobytes()
            elif len(data) > LONG_PIECE:
                self.recent[piece] = array("I", Prefixes(self.vocabulary, data).ids()).tobytes()
            else:
                short.append(piece)
        if short:
            self.recent.update(zip(short, self.batch.encode([p.encode() for p in short]), strict=True))

    def encode_all(self, texts: list[str]) -> list[bytes]:
        split = [self.pieces(t) for t in texts]
        self.learn(set().union(*split))
        return [b"".join(map(self.recent.__getitem__, pieces)) for pieces in split]

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def append(self, text: str, ids: bytes, more: str) -> bytes:
        """The encoding of ``text + more`` from that of ``text``: only its last piece can change."""
        pieces = self.pieces(text)
        if not pieces:
            return self.encode(more)
        return ids[: len(ids) - len(self.encode(pieces[-1]))] + self.encode(pieces[-1] + more)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.words.__getitem__, array("I", ids)))


def ascii_pattern(pattern: str) -> str:
    """The pattern with letters, numbers and white space as ASCII has them."""
    inside = {r"\p{L}": "A-Za-z", r"\p{N}": "0-9", r"\s": "\t-\r "}
    out, in_class, i = "", False, 0
    while i < len(pattern):
        name = next((n for n in inside if pattern.startswith(n, i)), None)
        if name:
            out += inside[name] if in_class else f"[{inside[name]}]"
            i += len(name)
        elif pattern.startswith(r"\S", i):
            out, i = out + "[^\t-\r ]", i + 2
        else:
            in_class = pattern[i] == "[" or in_class and pattern[i] != "]"
            out, i = out + pattern[i], i + 1
    return out


_encoders: dict[tuple[str, str], Encoder] = {}


def encoder_for(key: str, ranks: dict[bytes, int], pattern: str) -> Encoder:
    """One encoder a process."""
    if (key, pattern) not in _encoders:
        _encoders[key, pattern] = Encoder(ranks, pattern)
    return _encoders[key, pattern]


def _mapped(docs: DataFrame, text: Column, keep: list[Column], ranks_path: str, pattern: str, made: str, row) -> DataFrame:
    """``keep`` and what ``row(encoder, ids)`` makes of every whole text's ids, as columns ``made``.

    The ranks are read by the driver and sent to every executor once: the file's size bounds them.
    """
    spark = docs.sparkSession
    ranks = spark.sparkContext.broadcast(read_ranks(ranks_path))
    source = docs.select(*keep, F.coalesce(text.cast("string"), F.lit("")).alias("_text"))
    schema = StructType(source.drop("_text").schema.fields + StructType.fromDDL(made).fields)
    names = schema.names

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_for(ranks_path, ranks.value, pattern)
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                encoded = encoder.encode_all(batch.column(batch.num_columns - 1).to_pylist())
                columns = zip(*(row(encoder, ids) for ids in encoded), strict=True)
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *map(pa.array, columns)], names)

    return source.mapInArrow(read, schema)


def encode_documents(
    docs: DataFrame, ranks_path: str, pattern: str, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``(doc_id, n_tokens, ids)`` of every row, ``ids`` as little-endian unsigned 32-bit integers."""

    def row(encoder: Encoder, ids: bytes) -> tuple:
        return len(ids) // 4, ids

    return _mapped(docs, F.col(text), [F.col(doc_id).alias("doc_id")], ranks_path, pattern, "n_tokens long, ids binary", row)


def token_digests(
    docs: DataFrame, ranks_path: str, pattern: str, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)`` of every row: the text is encoded, and its ids decoded.

    NULL counts as empty and has no tokens. Repeated rows give repeated rows; an empty table gives an
    empty result; other columns are not read. Special tokens in a text are ordinary text.
    """

    def row(encoder: Encoder, ids: bytes) -> tuple:
        return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(encoder.decode(ids)).hexdigest()

    made = "n_tokens long, ids_sha256 string, decoded_sha256 string"
    return _mapped(docs, F.col(text), [F.col(doc_id).alias("doc_id")], ranks_path, pattern, made, row)


def token_counts(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text") -> DataFrame:
    """``(n_tokens)`` of every row."""
    return _mapped(docs, F.col(text), [], ranks_path, pattern, "n_tokens long", lambda _, ids: (len(ids) // 4,))

