"""Token ids of whole texts by a file of the tokenizers library.

Texts of plain characters go word by word, for tokenizers that lower-case, drop white space and split words
from signs: Arrow splits a group of texts and lists its distinct words, every word gets a number, new words are cut
and encoded together, and the ids of the group are gathered from the words' ids in one step. All other texts and
tokenizers go through the library whole.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

# Texts are encoded in groups of about this many characters, the library gets so many words at once,
# and words are forgotten after a group that leaves more than so many.
GROUP_CHARS = 1 << 20
CALL_WORDS = 256
CACHE_WORDS = 1 << 19

# ASCII and Latin-1 without controls: NFC leaves it alone and lower case is one letter for one.
_PLAIN = re.compile(r"[\t\n\x0b\x0c\r\x20-\x7e\xa1-\xff]*")
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# The same for lower-case ASCII words.
_ASCII_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+").findall


def _by_word(spec: dict) -> bool:
    """Whether white space only separates, so that words can be encoded one by one."""
    kinds = [x["type"] for x in (spec.get("normalizer") or {}).get("normalizers", [])]
    pre = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
    model = spec["model"]
    return (
        model["type"] == "BPE" and model["end_of_word_suffix"] == "</w>"
        and not any(model.get(x) for x in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges"))
        and kinds == ["NFC", "Replace", "Lowercase"]
        and spec["normalizer"]["normalizers"][1] == {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}
        and [x["type"] for x in pre] == ["Split", "ByteLevel"]
        and pre[0] == {"type": "Split", "pattern": {"Regex": _SPLIT}, "behavior": "Removed", "invert": True}
        and not pre[1]["add_prefix_space"] and not pre[1]["use_regex"]
        and all(x["content"].startswith("<|") and not x["lstrip"] and not x["rstrip"] for x in spec["added_tokens"])
    )


class _Numbers(dict):
    """Words by number in order of arrival; ``fresh`` are those without ids yet."""

    def __init__(self):
        super().__init__()
        self.fresh: list[str] = []

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        self.fresh.append(word)
        return number


def _lowered(words: pa.Array) -> list[str]:
    """Words without white space, as lower-case strings; one string for all is much faster than one for each."""
    if not len(words):
        return []
    listed = pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words)
    return pc.binary_join(listed, pa.scalar("\n", words.type))[0].as_py().lower().split("\n")


class Encoder:
    """Encodes lists of texts; one per worker and file, see ``encoder``."""

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer, models, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.by_word = _by_word(spec)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        if self.by_word:
            # The model alone, for words that are lower-cased, cut and spelled in byte symbols already. All of
            # them are new, so its own cache would only cost time.
            merges = [tuple(m.split(" ") if isinstance(m, str) else m) for m in spec["model"]["merges"]]
            bpe = models.BPE(spec["model"]["vocab"], merges, cache_capacity=0, end_of_word_suffix="</w>")
            self.model = Tokenizer(bpe)
            self.model.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
            symbols = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
            self.symbols = {c: "".join(x for x, _ in symbols.pre_tokenize_str(chr(c))) for c in range(0xA1, 0x100)}
            self.pieces = regex.compile(_SPLIT).findall
            # Whether a token ends a word: words joined by spaces can be told apart again.
            names = self.tokenizer.get_vocab(with_added_tokens=True)
            self.ends = np.zeros(max(names.values()) + 1, bool)
            self.ends[[i for name, i in names.items() if name.endswith("</w>")]] = True
        self._forget()

    def _forget(self) -> None:
        """No words: their numbers, and for each number where its ids start and how many they are."""
        self.numbers = _Numbers()
        self.ids = np.zeros(0, self.dtype)
        self.start, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _library(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.dtype)

    def _encode_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces, one after the other, and their numbers of ids; many pieces go in one text."""
        ids, sizes = [np.zeros(0, self.dtype)], [np.zeros(0, np.int64)]
        for at in range(0, len(pieces), CALL_WORDS):
            some = pieces[at : at + CALL_WORDS]
            spelled = " ".join([p if p.isascii() else p.translate(self.symbols) for p in some])
            found = np.array(self.model.encode_batch_fast([spelled], add_special_tokens=False)[0].ids, self.dtype)
            last = np.flatnonzero(self.ends[found]) + 1
            if len(last) == len(some) and last[-1] == len(found):
                ids.append(found)
                sizes.append(np.diff(last, prepend=0))
            else:
                each = [self._library(p) for p in some]
                ids += each
                sizes.append(np.array([len(x) for x in each], np.int64))
        return np.concatenate(ids), np.concatenate(sizes)

    def _learn(self) -> None:
        """Ids of all words without ids yet. Words that are several pieces get the ids of the pieces."""
        known, numbers = len(self.size), self.numbers
        fresh = numbers.fresh
        cut: dict[int, list[int]] = {}
        for n, word in enumerate(fresh[:], known):
            if not word.isalpha():
                parts = (_ASCII_PIECES if word.isascii() else self.pieces)(word)
                if parts != [word]:
                    cut[n] = [numbers[p] for p in parts]
        whole = [i for i in range(known, len(numbers)) if i not in cut]
        ids, size = self._encode_pieces([fresh[i - known] for i in whole])
        first = len(self.ids) + np.cumsum(size) - size
        self.start, self.size = (np.r_[x, np.zeros(len(fresh), np.int64)] for x in (self.start, self.size))
        self.start[whole], self.size[whole] = first, size
        self.ids = np.r_[self.ids, ids]
        if cut:
            parts = np.array([p for x in cut.values() for p in x], np.int64)
            owner = np.repeat(np.arange(len(cut)), [len(x) for x in cut.values()])
            own = np.array(list(cut), np.int64)
            self.size[own] = np.bincount(owner, self.size[parts], len(cut)).astype(np.int64)
            self.start[own] = len(self.ids) + np.cumsum(self.size[own]) - self.size[own]
            self.ids = np.r_[self.ids, self._gather(parts)]
        numbers.fresh = []

    def _gather(self, numbers: np.ndarray) -> np.ndarray:
        size = self.size[numbers]
        ahead = np.cumsum(size) - size
        return self.ids[np.repeat(self.start[numbers] - ahead, size) + np.arange(size.sum())]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of every text as little-endian integers of ``dtype``."""
        out: list[bytes] = [b""] * len(texts)
        split = []
        for i, text in enumerate(texts):
            if self.by_word and "<|" not in text and _PLAIN.fullmatch(text):
                split.append(i)
            else:
                out[i] = self._library(text).tobytes()
        if split:
            words = pc.ascii_split_whitespace(pa.array([texts[i] for i in split], pa.large_string()))
            coded = words.flatten().dictionary_encode()
            own = np.fromiter(map(self.numbers.__getitem__, _lowered(coded.dictionary)), np.int64, len(coded.dictionary))
            if self.numbers.fresh:
                self._learn()
            numbers = own[coded.indices.to_numpy()]
            total = np.r_[0, np.cumsum(self.size[numbers])]
            cuts = (total[words.offsets.to_numpy()] * self.dtype.itemsize).tolist()
            data = self._gather(numbers).tobytes()
            for i, a, z in zip(split, cuts, cuts[1:]):
                out[i] = data[a:z]
        if len(self.numbers) > CACHE_WORDS:
            self._forget()
        return out


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def groups(texts: list[str], chars: int = GROUP_CHARS) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) of groups of bounded size."""
    at = 0
    while at < len(texts):
        to, n = at, 0
        while to < len(texts) and (to == at or n + len(texts[to]) <= chars):
            n += len(texts[to])
            to += 1
        yield at, texts[at:to]
        at = to


def text_batches(column, rows: int = 1024) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) of an Arrow string column in bounded groups; null is the empty text."""
    for at in range(0, len(column), rows):
        texts = [x or "" for x in column.slice(at, rows).to_pylist()]
        for first, group in groups(texts):
            yield at + first, group


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
