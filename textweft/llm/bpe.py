"""Byte-pair encoding and decoding with a given vocabulary.

Each piece of text becomes a doubly linked list of symbols. A priority queue holds
the merge ranks of neighbouring pairs; an entry whose symbols have changed since it
was queued is skipped. Decoding puts vocabulary strings together. Texts are encoded
where they lie, without a shuffle; each task remembers a bounded number of pieces.
"""

import json
import re
import unicodedata
from collections.abc import Callable
from heapq import heapify, heappop, heappush

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from tokenizers import Tokenizer

from textweft.llm.common import digest, map_columns

# How many chunks and pieces a task keeps in mind, twice over, before it forgets the oldest.
CHUNKS, PIECES = 150_000, 300_000
PLAIN = "\u0370"  # below this every Unicode version agrees on letters and digits


class Memory(dict):
    """A bounded memory of what ``find`` returned; entries not asked for lately are forgotten."""

    def __init__(self, find: Callable, most: int):
        super().__init__()
        self.find, self.most, self.older = find, most, {}

    def __missing__(self, key):
        entry = self.older.get(key)
        if entry is None:
            entry = self.find(key)
        if len(key) <= 64:
            if len(self) >= self.most:
                self.older = dict(self)
                self.clear()
            self[key] = entry
        return entry


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in a vocabulary file."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    symbols, spare = {b: chr(b) for b in shown}, 256
    for b in range(256):
        if b not in symbols:
            symbols[b], spare = chr(spare), spare + 1
    return [symbols[b] for b in range(256)]


class Codec:
    """Encoder and decoder for a tokenizer file that drops white space and marks word ends.

    The file's own normalizer and splitter cut a chunk without white space into pieces,
    so that letters and digits are told apart as the file means it.
    """

    def __init__(self, definition: str):
        spec = json.loads(definition)
        model = spec["model"]
        vocab = model["vocab"]
        kinds = [n["type"] for n in (spec.get("normalizer") or {}).get("normalizers", [])]
        if kinds != ["NFC", "Replace", "Lowercase"] or spec.get("decoder") or model.get("unk_token"):
            raise ValueError("this tokenizer file needs steps that are not built here")
        tokenizer = Tokenizer.from_str(definition)
        self.normalizer, self.splitter = tokenizer.normalizer, tokenizer.pre_tokenizer
        end = model.get("end_of_word_suffix") or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.strings = {i: s for s, i in vocab.items()} | {i: s for s, i in self.special.items()}
        symbols = byte_symbols()
        self.inner = {s: vocab.get(s) for s in symbols}
        self.last = {s: vocab.get(s + end) for s in symbols}
        if len(vocab) >= 1 << 16:
            raise ValueError("ids of this vocabulary don't fit sixteen bits")
        pairs = [pair if isinstance(pair, list) else pair.split(" ") for pair in model["merges"]]
        self.ranks = {vocab[left] << 16 | vocab[right]: rank for rank, (left, right) in enumerate(pairs)}
        self.results = [vocab[left + right] for left, right in pairs]
        splits = [p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"]
        self.plain_pieces = regex.compile(splits[0]["pattern"]["Regex"]).findall
        self.symbols = {b: s for b, s in enumerate(symbols)}
        self.pieces, self.chunks = Memory(self.encode_plain, PIECES), Memory(self.encode_chunk, CHUNKS)

    def encode_piece(self, piece: str) -> list[int]:
        """Ids of one piece, given as the printable characters of its bytes."""
        ids = [self.inner[s] for s in piece[:-1]] + [self.last[piece[-1]]]
        if None in ids:
            ids = [i for i in ids if i is not None]
        ranks, results, n = self.ranks, self.results, len(ids)
        if n < 2:
            return ids
        # an entry is the merge's rank and the left symbol's place in one number
        bits = n.bit_length()
        mask, find = (1 << bits) - 1, ranks.get
        queue = [
            rank << bits | at
            for at, (left, right) in enumerate(zip(ids, ids[1:]))
            if (rank := find(left << 16 | right)) is not None
        ]
        if not queue:
            return ids
        heapify(queue)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        ids.append(-1)  # nothing merges with what lies behind the last symbol
        while queue:
            entry = heappop(queue)
            at = entry & mask
            left, then = ids[at], after[at]
            if left < 0 or find(left << 16 | ids[then]) != entry >> bits:
                continue  # stale: one of the two symbols has changed since
            ids[then] = -1
            ids[at] = merged = results[entry >> bits]
            after[at] = following = after[then]
            if following < n:
                before[following] = at
                rank = find(merged << 16 | ids[following])
                if rank is not None:
                    heappush(queue, rank << bits | at)
            earlier = before[at]
            if earlier >= 0:
                rank = find(ids[earlier] << 16 | merged)
                if rank is not None:
                    heappush(queue, rank << bits | earlier)
        return [i for i in ids if i >= 0]

    def encode_plain(self, piece: str) -> tuple[str, str]:
        ids = self.encode_piece(piece.encode("utf-8").decode("latin-1").translate(self.symbols))
        return " ".join(map(str, ids)), self.decode(ids)

    def encode_chunk(self, chunk: bytes) -> tuple[str, str]:
        text = chunk.decode("utf-8", "replace")
        if max(text) < PLAIN and "<|" not in text:
            if not text.isascii():
                text = unicodedata.normalize("NFC", text)
            found = [self.pieces[piece] for piece in self.plain_pieces(text.lower())]
            return found[0] if len(found) == 1 else (" ".join([e[0] for e in found]), " ".join([e[1] for e in found]))
        ids = []
        for part in self.cut.split(text) if self.cut else [text]:
            if part in self.special:
                ids.append(self.special[part])
            elif part:
                for piece, _ in self.splitter.pre_tokenize_str(self.normalizer.normalize_str(part)):
                    ids += self.encode_piece(piece)
        return " ".join(map(str, ids)), self.decode(ids)

    def entries(self, text: str) -> list[tuple[str, str]]:
        """For each chunk its ids and its vocabulary strings, each joined by a space.

        Nothing that the tokenizer looks at reaches across ASCII white space. Letters are
        folded first so that more chunks are alike; names of special tokens keep their case.
        """
        data = text.encode("utf-8", "replace")
        chunks = (data if b"<|" in data else data.lower()).split()
        return [entry for entry in map(self.chunks.__getitem__, chunks) if entry[0]]

    def decode(self, ids: list[int]) -> str:
        """Vocabulary strings joined by a space, as a file without a decoder asks for."""
        return " ".join(self.strings[i] for i in ids if i in self.strings)


_codecs: dict[int, Codec] = {}


def codec(definition: str) -> Codec:
    """One codec for each worker process and file."""
    key = hash(definition)
    if key not in _codecs:
        _codecs[key] = Codec(definition)
    return _codecs[key]


OUTPUTS = {
    "n_tokens": T.LongType(),
    "token_ids": T.ArrayType(T.IntegerType()),
    "decoded": T.StringType(),
    "ids_sha256": T.StringType(),
    "decoded_sha256": T.StringType(),
}


def encode_texts(
    docs: DataFrame,
    tokenizer_file: str,
    outputs: tuple[str, ...] = ("n_tokens", "token_ids", "decoded"),
    text: str = "text",
    keep: list[str] | None = None,
) -> DataFrame:
    """Add ``outputs`` for each row's whole text; a null text is an empty one.

    ``ids_sha256`` is the digest of the decimal ids joined by a space, ``decoded_sha256``
    that of the decoded text. An empty text has no tokens, an empty array and an empty
    decoded text. Repeated rows stay repeated; a column with an output's name is replaced.
    ``tokenizer_file`` is read on the driver; its bounded content travels with the tasks.
    """
    with open(tokenizer_file, encoding="utf-8") as file:
        definition = file.read()
    Codec(definition)  # refuse an unfit file before any task starts
    adds = T.StructType([T.StructField(name, OUTPUTS[name]) for name in outputs])

    def work(columns: dict[str, list]) -> dict[str, list]:
        bpe = codec(definition)
        got: dict[str, list] = {name: [] for name in outputs}
        for value in columns[text]:
            entries = bpe.entries(value or "")
            ids = " ".join([e[0] for e in entries])
            decoded = " ".join([e[1] for e in entries])
            if "n_tokens" in got:
                got["n_tokens"].append(ids.count(" ") + 1 if ids else 0)
            if "token_ids" in got:
                got["token_ids"].append(np.fromstring(ids, dtype=np.int32, sep=" "))
            if "decoded" in got:
                got["decoded"].append(decoded)
            if "ids_sha256" in got:
                got["ids_sha256"].append(digest(ids))
            if "decoded_sha256" in got:
                got["decoded_sha256"].append(digest(decoded))
        return got

    return map_columns(docs, [text], adds, work, keep)


def decode_tokens(df: DataFrame, tokenizer_file: str, ids: str = "token_ids", name: str = "decoded") -> DataFrame:
    """Add the text of each row's token ids; null ids give an empty text."""
    with open(tokenizer_file, encoding="utf-8") as file:
        definition = file.read()

    def work(columns: dict[str, list]) -> dict[str, list]:
        bpe = codec(definition)
        return {name: [bpe.decode(i or []) for i in columns[ids]]}

    return map_columns(df, [ids], T.StructType([T.StructField(name, T.StringType())]), work)
