"""BPE encoding and decoding: batched numpy merge rounds.

Symbols of many words lie in one flat array. A round looks up every neighbouring pair by binary search over
the sorted pair keys, takes each word's pair of lowest rank, and merges all its occurrences; words without a
known pair leave. Text is cut at white space first, so each distinct piece is merged once a batch.
"""

from __future__ import annotations

import json
import re
import unicodedata

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_text

#: Unicode's White_Space; str.split() would also cut at 1C to 1F.
SPACES = re.compile("[" + "".join(map(chr, (*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))) + "]+")
ODD = re.compile("[\x1c-\x1f]")


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return [chr(256 + rest.index(b)) if b in rest else chr(b) for b in range(256)]


class WordBpe:
    """A tokenizers file of kind BPE with word ends, byte-level symbols and a Split pattern."""

    def __init__(self, path: str, cache: int = 300_000):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab, self.end = model["vocab"], model["end_of_word_suffix"] or ""
        self.pattern = regex.compile(next(x["pattern"]["Regex"] for x in spec["pre_tokenizer"]["pretokenizers"] if x["type"] == "Split"))
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.cuts = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.tokens = [""] * (1 + max([*vocab.values(), *self.special.values()]))
        for table in (vocab, self.special):
            for token, i in table.items():
                self.tokens[i] = token
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.width = len(self.tokens)
        keys = np.array([vocab[a] * self.width + vocab[b] for a, b in merges], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order
        self.made = np.array([vocab[a + b] for a, b in merges], np.int64)
        symbols = byte_symbols()
        self.inner = np.array([vocab[s] for s in symbols], np.int64)
        self.last = np.array([vocab[s + self.end] for s in symbols], np.int64)
        self.most, self.cache = cache, {}

    def merge(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of each word."""
        sizes = np.array([len(w) for w in words], np.int64)
        raw = np.frombuffer(b"".join(words), np.uint8)
        ends = np.cumsum(sizes)
        ids = self.inner[raw]
        ids[ends - 1] = self.last[raw[ends - 1]]
        word = np.repeat(np.arange(len(words)), sizes)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        none = len(self.ranks)
        while len(ids) > 1:
            pair = ids[:-1] * self.width + ids[1:]
            at = np.minimum(np.searchsorted(self.keys, pair), none - 1)
            rank = np.where((self.keys[at] == pair) & (word[:-1] == word[1:]), self.ranks[at], none)
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            lowest = np.minimum.reduceat(np.r_[rank, none], starts)
            of_word = np.repeat(lowest, np.diff(np.r_[starts, len(word)]))
            ready = of_word == none
            hit = np.flatnonzero((rank == of_word[:-1]) & ~ready[:-1])
            # a run of neighbouring hits is one symbol repeated: every second one merges, from the left
            fresh = np.r_[True, np.diff(hit) != 1]
            hit = hit[(np.arange(len(hit)) - np.flatnonzero(fresh)[np.cumsum(fresh) - 1]) % 2 == 0] if len(hit) else hit
            ids[hit] = self.made[rank[hit]]
            stay = ~ready
            stay[hit + 1] = False
            done.append((word[ready], ids[ready]))
            word, ids = word[stay], ids[stay]
        done.append((word, ids))
        word, ids = (np.concatenate([d[k] for d in done]) for k in (0, 1))
        order = np.argsort(word, kind="stable")
        bounds = np.searchsorted(word[order], np.arange(len(words) + 1))
        ids = ids[order]
        return [ids[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]

    def learn(self, pieces: set[str]) -> None:
        """Puts the ids of every piece of text without white space into the cache, as little-endian bytes."""
        words: dict[str, int] = {}
        made: list[tuple[str, list]] = []
        for piece in pieces:
            parts: list = []
            for part in self.cuts.split(piece) if self.cuts and any(s in piece for s in self.special) else (piece,):
                if part in self.special:
                    parts.append(np.array([self.special[part]], "<u4").tobytes())
                else:
                    # lower case goes letter by letter: no final sigma
                    low = unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()
                    parts += [words.setdefault(w, len(words)) for w in self.pattern.findall(low)]
            made.append((piece, parts))
        got = [x.astype("<u4").tobytes() for x in self.merge([w.encode() for w in words])] if words else []
        for piece, parts in made:
            self.cache[piece] = b"".join(p if isinstance(p, bytes) else got[p] for p in parts)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts as little-endian unsigned 32-bit integers."""
        cut = [SPACES.split(t) if ODD.search(t) else t.split() for t in texts]
        if len(self.cache) > self.most:
            self.cache.clear()
        seen: set[str] = set().union(*cut) - self.cache.keys()
        if seen:
            self.learn(seen)
        get = self.cache.__getitem__
        return [b"".join(map(get, c)) for c in cut]

    def decode(self, ids: list[bytes]) -> list[str]:
        """The tokens' texts, joined by a space: the file names no decoder."""
        token = self.tokens.__getitem__
        return [" ".join(map(token, np.frombuffer(x, "<u4").tolist())) for x in ids]


_LOADED: dict[str, WordBpe] = {}


def encode_decode(docs: DataFrame, path: str, keep: list[str] | None = None, text: str = "text") -> DataFrame:
    """Adds ids (binary: little-endian unsigned 32-bit) and decoded (string) of every whole text.

    Null counts as empty text, which has no ids and decodes to ''. Repeated rows each give a row; an empty
    table gives none; of other columns only `keep` stays, so clashing names don't matter. One map, no shuffle.
    """

    def run(texts: list[str]) -> dict[str, list]:
        if path not in _LOADED:
            _LOADED[path] = WordBpe(path)
        bpe = _LOADED[path]
        ids = bpe.encode(texts)
        return {"ids": ids, "decoded": bpe.decode(ids)}

    return map_text(docs, run, keep or ["doc_id"], text, "ids binary, decoded string")


def digests(encoded: DataFrame, keep: list[str]) -> DataFrame:
    """n_tokens, ids_sha256 and decoded_sha256 of what encode_decode returns."""
    return encoded.select(*keep, F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
