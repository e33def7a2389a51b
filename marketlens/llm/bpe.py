"""BPE encoding and decoding (operator 10).

Backtracking encoder: an Aho-Corasick automaton over the vocabulary finds the
longest token that starts at each position of a word; it is tried first, and a
token may follow another only if the pair is *compatible*, that is, if merging
by rank would never merge across their border. When nothing fits, the last
token is taken back and its next shorter prefix is tried; end positions proved
to be dead ends are marked and never tried again, so the work is linear in the
word. The outcome is exactly that of merging by rank. Decoding looks tokens up in one blob of
bytes through a table of offsets.

The vocabulary file (``tokenizers`` JSON: BPE with an end-of-word suffix,
NFC, lower case, words split by a pattern) is read by the driver and broadcast;
its size is that of the file and does not grow with the data. Letters added
after Unicode 16 are classed by the ``regex`` package, which may know more of
them than the ``tokenizers`` library.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from array import array
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType

from marketlens.llm.base import arrow_limits, per_batch, pick, position

# --- fixed values: the vocabulary's word pattern and suffix -------------------
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
SUFFIX = "</w>"
_ASCII_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[A-Za-z]+|[0-9]|[^\sA-Za-z0-9]+", re.ASCII)   # the same words of an ASCII piece

MAX_FILE = 64 << 20     # a vocabulary above this is refused: it is broadcast
MAX_CACHED = 150_000    # words in each of a worker's two generations of cached words
_END = 0x1000           # shift of a word's last symbol, which has its own alphabet
_RENDER = 1 << 20       # tokens rendered to text at once


def _byte_letters() -> list[str]:
    """Byte-level alphabet: printable bytes stand for themselves, the others
    for the code points from 256 on."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in shown]
    letters = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [letters[b] for b in range(256)]


class OffsetTable:
    """Strings by id in one blob, with a separator after each."""

    def __init__(self, items: list[bytes], separator: bytes = b" "):
        parts = [x + separator for x in items]
        self.blob = np.frombuffer(b"".join(parts), dtype=np.uint8)
        self.at = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)

    def join(self, ids: np.ndarray) -> bytes:
        """The strings of ``ids`` joined by the separator."""
        out = []
        for i in range(0, len(ids), _RENDER):
            part = ids[i:i + _RENDER]
            start, size = self.at[part], self.at[part + 1] - self.at[part]
            ends = np.cumsum(size)
            index = np.repeat(start - (ends - size), size) + np.arange(ends[-1])
            out.append(self.blob[index].tobytes())
        return b"".join(out)[:-1]


class Vocabulary:
    """Encoder and decoder for one vocabulary file."""

    def __init__(self, file: bytes):
        spec = json.loads(file)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("end_of_word_suffix") != SUFFIX or spec.get("decoder"):
            raise ValueError("only BPE with an end-of-word suffix and without a decoder is supported")
        ids = model["vocab"]
        letters = _byte_letters()
        self.letters = {b: c for b, c in enumerate(letters)}
        symbols = {c: c for c in letters} | {c + SUFFIX: chr(ord(c) + _END) for c in letters}
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.pairs: dict[tuple[int, int], int] = {}
        self.halves: dict[int, tuple[int, int]] = {ids[s]: (ids[s], ids[s]) for s in symbols}
        last = max(self.halves)
        for left, right in merges:
            whole = ids[left + right]
            if whole <= last:
                raise ValueError("token ids must follow the order of merges")
            last = whole
            symbols[left + right] = symbols[left] + symbols[right]
            self.pairs[ids[left], ids[right]] = whole
            self.halves[whole] = (ids[left], ids[right])
        self.fits: dict[int, bool] = {}    # by left << 32 | right
        self.whole: dict[str, int] = {}
        self.automaton = ahocorasick.Automaton()
        for name, symbol in symbols.items():
            token = ids[name]
            left, right = self.halves[token]
            if left != token and not self._unmerged(left, right, token):
                continue  # merging by rank never yields this token
            self.whole[symbol] = token
            self.automaton.add_word(symbol, (token, len(symbol)))
        self.automaton.make_automaton()
        self.size = [0] * (last + 1)
        self.shorter: list[int | None] = [None] * (last + 1)   # a token's longest beginning that is a token too
        for symbol, token in self.whole.items():
            self.size[token] = len(symbol)
            self.shorter[token] = next((self.whole[symbol[:n]] for n in range(len(symbol) - 1, 0, -1) if symbol[:n] in self.whole), None)
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special = {k: np.array([v], np.int32).tobytes() for k, v in special.items()}
        self.at_special = regex.compile("(" + "|".join(map(regex.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        self.words = regex.compile(WORDS)
        strings = {v: k for k, v in (ids | special).items()}
        size = max(strings) + 1
        self.texts = OffsetTable([strings.get(i, "").encode() for i in range(size)])
        self.numbers = OffsetTable([str(i).encode() for i in range(size)])
        self.recent: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _unmerged(self, left: int, right: int, limit: float = float("inf")) -> bool:
        """True if merging by rank keeps the border between the two tokens when
        only merges below ``limit`` count. Undoes the merges inside both from
        the latest back, looking at each step for a merge across the border."""
        while True:
            across = self.pairs.get((left, right))
            if across is not None and across < limit:
                return False
            if left > right:
                order = ((left, True), (right, False))
            else:
                order = ((right, False), (left, True))
            for token, on_left in order:
                a, b = self.halves[token]
                if a != token:
                    limit = token if on_left else token + 1
                    left, right = (b, right) if on_left else (left, a)
                    break
            else:
                return True

    def compatible(self, left: int, right: int) -> bool:
        """The pair table, filled as pairs are met."""
        key = left << 32 | right
        known = self.fits.get(key)
        if known is None:
            if len(self.fits) >= 4 * MAX_CACHED:
                self.fits.clear()
            known = self.fits[key] = self._unmerged(left, right)
        return known

    def word_ids(self, word: str) -> list[int]:
        """Tokens of one word (not empty)."""
        letters = self.letters
        # printable ASCII stands for itself
        text = word if word.isascii() and word.isprintable() else "".join([letters[b] for b in word.encode()])
        text = text[:-1] + chr(ord(text[-1]) + _END)
        token = self.whole.get(text)
        if token is not None:
            return [token]
        n = len(text)
        longest: list[int | None] = [None] * (n + 1)
        for end, (token, size) in self.automaton.iter(text):
            longest[end + 1 - size] = token   # shorter before longer
        sizes, shorter, fits = self.size, self.shorter, self.fits
        dead = bytearray(n + 1)
        path: list[int] = []
        last, at, token = None, 0, longest[0]
        while at < n:
            while token is not None:
                end = at + sizes[token]
                if not dead[end]:
                    if last is None:
                        break
                    fit = fits.get(last << 32 | token)
                    if fit or (fit is None and self.compatible(last, token)):
                        break
                token = shorter[token]
            if token is not None:
                path.append(token)
                last, at, token = token, end, longest[end]
            else:
                dead[at] = 1
                token = path.pop()
                at -= sizes[token]
                last, token = path[-1] if path else None, shorter[token]
        return path

    def _chunk(self, chunk: str) -> bytes:
        """Ids of a piece without white space that is not among the recent ones."""
        out = self.older.get(chunk)
        if out is None:
            if not chunk.isascii():
                words = self.words.findall(chunk)
            else:
                words = [chunk] if chunk.isalpha() else _ASCII_WORDS.findall(chunk)
            if len(words) == 1:
                out = array("i", self.word_ids(words[0])).tobytes()
            else:
                out = b"".join([self.recent.get(w) or self._chunk(w) for w in words])
        if len(chunk) <= 64:
            if len(self.recent) >= MAX_CACHED:
                self.older, self.recent = self.recent, {}
            self.recent[chunk] = out
        return out

    def _plain(self, text: str) -> list[bytes]:
        if not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        # letter by letter: a final sigma gets no form of its own
        text = text.replace("Σ", "σ").lower()
        # str.split() also splits at the four separators, which count as signs here
        chunks = regex.split(r"\s+", text) if any(c in text for c in "\x1c\x1d\x1e\x1f") else text.split()
        return [self.recent.get(c) or self._chunk(c) for c in chunks if c]

    def encode(self, text: str) -> np.ndarray:
        """Token ids (int32) of a whole text."""
        if self.at_special is None:
            parts = self._plain(text)
        else:
            parts = []
            for piece in self.at_special.split(text):
                parts += [self.special[piece]] if piece in self.special else self._plain(piece)
        return np.frombuffer(b"".join(parts), dtype=np.int32)

    def decode(self, ids: np.ndarray) -> bytes:
        """The decoded text in UTF-8: the tokens' strings joined by one space."""
        return self.texts.join(np.asarray(ids))


@lru_cache(maxsize=2)
def _vocabulary(file: bytes) -> Vocabulary:
    return Vocabulary(file)


def _shared(df: DataFrame, path: str):
    with open(path, "rb") as f:
        file = f.read(MAX_FILE + 1)
    if len(file) > MAX_FILE:
        raise ValueError(f"{path} is larger than {MAX_FILE} bytes")
    return df.sparkSession.sparkContext.broadcast(file)


def encode(docs: DataFrame, vocabulary: str, column: str = "text") -> DataFrame:
    """All columns of ``docs``, then ``token_ids array<int>``, ``n_tokens long``
    (columns of these names in the input are replaced). A null text counts as
    empty and has no tokens; rows are independent, so repeated rows, ties and
    empty tables need no care. Texts are encoded whole, whatever their length."""
    file = _shared(docs, vocabulary)
    arrow_limits(docs.sparkSession)
    kept = [i for i, c in enumerate(docs.columns) if c.lower() not in ("token_ids", "n_tokens")]
    at = position(docs, column)
    flat = docs.toDF(*[f"_in{i}" for i in range(len(docs.columns))])
    names = [f"_in{i}" for i in kept]
    fields = [flat.schema[n] for n in names]
    schema = type(flat.schema)(fields).add("token_ids", ArrayType(IntegerType())).add("n_tokens", LongType())

    def run(batches):
        vocab = _vocabulary(file.value)
        for batch in batches:
            ids = [vocab.encode(t or "") for t in batch.column(at).to_pylist()]
            sizes = np.array([len(x) for x in ids], np.int64)
            ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            flat_ids = pa.array(np.concatenate(ids) if ids else np.empty(0, np.int32), pa.int32())
            tokens = pa.ListArray.from_arrays(pa.array(ends), flat_ids)
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in kept], tokens, pa.array(sizes)], names=[*names, "token_ids", "n_tokens"])

    return flat.mapInArrow(run, schema).toDF(*[docs.columns[i] for i in kept], "token_ids", "n_tokens")


def decode(tokens: DataFrame, vocabulary: str, column: str = "token_ids") -> DataFrame:
    """All columns, then ``decoded string`` (replaced if the input has it). Null
    ids decode to the empty string; an id outside the vocabulary is an error."""
    file = _shared(tokens, vocabulary)
    arrow_limits(tokens.sparkSession)
    kept = [i for i, c in enumerate(tokens.columns) if c.lower() != "decoded"]
    at = position(tokens, column)
    flat = tokens.toDF(*[f"_in{i}" for i in range(len(tokens.columns))])
    names = [f"_in{i}" for i in kept]
    schema = type(flat.schema)([flat.schema[n] for n in names]).add("decoded", StringType())

    def run(batches):
        vocab = _vocabulary(file.value)
        for batch in batches:
            lists = batch.column(at)
            texts = [vocab.decode(v.values.to_numpy()) .decode() if v.is_valid and len(v.values) else "" for v in lists]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in kept], pa.array(texts, pa.string())], names=[*names, "decoded"])

    return flat.mapInArrow(run, schema).toDF(*[tokens.columns[i] for i in kept], "decoded")


def digests(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Per document: ``doc_id, n_tokens, ids_sha256, decoded_sha256``. Encodes
    and decodes in one pass, so neither the ids nor the decoded texts leave the
    task. A null text counts as empty; a null ``doc_id`` stays null."""
    file = _shared(docs, vocabulary)

    def run(batch: pa.RecordBatch) -> dict:
        vocab = _vocabulary(file.value)
        sha = hashlib.sha256
        count, by_ids, by_text = [], [], []
        for text in batch.column(1).to_pylist():
            ids = vocab.encode(text or "")
            count.append(len(ids))
            by_ids.append(sha(vocab.numbers.join(ids)).hexdigest())
            by_text.append(sha(vocab.decode(ids)).hexdigest())
        return {"doc_id": batch.column(0), "n_tokens": pa.array(count, pa.int64()), "ids_sha256": pa.array(by_ids, pa.string()), "decoded_sha256": pa.array(by_text, pa.string())}

    docs = pick(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("bigint"))
    return per_batch(docs, run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def default_vocabulary() -> str:
    """The public 49k word vocabulary, where its package is installed."""
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")
