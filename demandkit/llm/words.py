"""Public tokenizers by words: every distinct word is encoded once, texts are put together from that.

Both kinds of tokenizer end a token before a space between two characters that are no white space,
whatever stands elsewhere; so the ids of a text are those of its units, each a space and what follows
up to the next such one. A byte-level tokenizer also ends one before any other space that touches
something else than white space.
"""

from __future__ import annotations

import os
import re
import sys
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain, compress, pairwise

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
import tiktoken
from tokenizers import Tokenizer, pre_tokenizers

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")
#: Words, pieces of words, and ids of either kept; beyond that all are forgotten and learned again.
MAX_WORDS, MAX_PIECES, MAX_IDS = 1 << 19, 1 << 20, 1 << 24
#: Bytes of texts put together at a time, and new pieces in one text for the library.
_AT_ONCE, _JOINED = 4 << 20, 400
_SPACES = "".join(c for c in map(chr, range(sys.maxunicode + 1)) if c.isspace())
#: A space within white space, or at its end: a token may reach over it.
_OVER = rf"[{_SPACES}] (?:[{_SPACES}]|\z)"
_ACROSS = re.compile(r"\s \s|\s \Z")
#: The first character of which libraries may not agree what it is.
_GAP = "ɐ"
#: Such ones, and white space beside a space.
_UNLIKE = re.compile(rf" \s|\s |[{_GAP}-\U0010ffff]")
_STRETCH = 2000
_SAFE = re.compile(r"(?<=\S) (?=\S)")


def byte_alphabet() -> dict[str, int]:
    """The character that byte-level vocabularies write for each byte: printable ones stand for themselves."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(rest)}


class Learned(dict):
    """Lists of ids, each under the number of what they stand for; ``learn`` gives those of new keys."""

    def __init__(self, learn: Callable[[list[str]], tuple[np.ndarray, np.ndarray]]):
        self.learn = learn
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.fresh: list[str] = []
        self.ids, self.begins, self.counts = np.empty(0, np.uint16), np.empty(0, np.int64), np.empty(0, np.int64)

    def __missing__(self, key: str) -> int:
        n = self[key] = len(self)
        self.fresh.append(key)
        return n

    def numbers(self, keys: list[str]) -> np.ndarray:
        found = np.fromiter(map(self.__getitem__, keys), np.int64, len(keys))
        if self.fresh:
            ids, counts = self.learn(self.fresh)
            self.begins = np.concatenate([self.begins, len(self.ids) + np.cumsum(counts) - counts])
            self.counts = np.concatenate([self.counts, counts])
            self.ids = np.concatenate([self.ids, ids])
            self.fresh = []
        return found


def _lists(ids: np.ndarray, begins: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The lists of ids that begin there and have so many."""
    at = np.repeat(begins - (np.cumsum(counts) - counts), counts)
    at += np.arange(len(at))
    return ids[at]


def _strings(column: pa.Array) -> list[str]:
    """The column as a list, by one string where no space is in it."""
    if not len(column):
        return []
    whole = pa.ListArray.from_arrays(pa.array([0, len(column)], pa.int32()), column)
    found = pc.binary_join(whole, pa.scalar(" ", column.type))[0].as_py().split(" ")
    return found if len(found) == len(column) else column.to_pylist()


class ByteWords:
    """Ids of texts by a byte-level vocabulary, as bytes of 16-bit numbers.

    ``words`` has the ids of a space and a word. Words of Latin characters are put together from
    ``pieces``, the stretches of letters, digits or other signs that the vocabulary's own pattern cuts;
    new pieces go to the library's model many in one text. All other words go to the library as they are.
    """

    def __init__(self, path: str = BYTE_BPE, plain_specials: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = plain_specials
        self.specials = [] if plain_specials else [t.content for t in self.library.get_added_tokens_decoder().values()]
        if self.library.get_vocab_size() > 1 << 16:
            raise ValueError(f"{path}: ids do not fit into 16 bits")
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.letters = {b: c for c, b in byte_alphabet().items()}
        # its texts are pieces in the vocabulary's letters, between spaces
        self.model = Tokenizer.from_file(path)
        self.model.encode_special_tokens = True
        self.model.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.sizes = np.zeros(1 << 16, np.int64)
        for token, n in self.library.get_vocab().items():
            self.sizes[n] = len(token)
        self.pieces, self.words = Learned(self._learn_pieces), Learned(self._learn_words)

    def _library(self, texts: list[str], by: Tokenizer | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and how many each has."""
        made = [e.ids for e in (by or self.library).encode_batch_fast(texts, add_special_tokens=False)]
        counts = np.fromiter(map(len, made), np.int64, len(made))
        return np.fromiter(chain.from_iterable(made), np.uint16, int(counts.sum())), counts

    def _learn_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        apart = _GAP.encode().decode("latin-1").translate(self.letters)
        own = _GAP.join(pieces).encode().decode("latin-1").translate(self.letters).split(apart)
        ids, _ = self._library([" ".join(own[n : n + _JOINED]) for n in range(0, len(own), _JOINED)], self.model)
        ends, upto = np.cumsum(self.sizes[ids]), np.cumsum(np.fromiter(map(len, own), np.int64, len(own)))
        at = np.searchsorted(ends, upto)
        if len(ends) and ends[-1] == upto[-1] and (ends[at] == upto).all():
            return ids, np.diff(at, prepend=-1)
        return self._library(own, self.model)  # a vocabulary that has not all bytes

    def _plain(self, word: str) -> bool:
        return bool(word) and " " not in word and not _UNLIKE.search(f" {word} ") and not any(s in f" {word}" for s in self.specials)

    def _learn_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        text = " " + " ".join(words)
        plain = np.ones(len(words), bool)
        if _UNLIKE.search(text + " ") or text.count(" ") != len(words) or any(s in text for s in self.specials):
            plain = np.fromiter(map(self._plain, words), bool, len(words))
            text = "".join(" " + w for w in compress(words, plain))
        found = self.pattern.findall(text)
        numbers = self.pieces.numbers(found)
        begins, many = self.pieces.begins[numbers], self.pieces.counts[numbers]
        ids = _lists(self.pieces.ids, begins, many)
        # only the first piece of a word has a space
        first = np.flatnonzero(np.fromiter((p[0] == " " for p in found), bool, len(found)))
        many = np.add.reduceat(many, first) if len(first) else many
        if plain.all():
            return ids, many
        others, rest = self._library([" " + w for w in compress(words, ~plain)])
        counts, begins = np.empty((2, len(words)), np.int64)
        counts[plain], counts[~plain] = many, rest
        begins[plain], begins[~plain] = np.cumsum(many) - many, len(ids) + np.cumsum(rest) - rest
        return _lists(np.concatenate([ids, others]), begins, counts), counts

    def _parts(self, texts: pa.Array) -> pa.ListArray:
        """Every text without the spaces it can be cut at."""
        odd = pc.match_substring_regex(texts, _OVER)
        for special in self.specials:
            odd = pc.or_(odd, pc.match_substring(texts, special))
        parts, rows = pc.split_pattern(texts, " "), np.flatnonzero(odd.to_numpy(zero_copy_only=False))
        if len(rows):
            own = pa.array([_SAFE.split(t) for t in texts.take(pa.array(rows)).to_pylist()], parts.type)
            order = np.arange(len(texts))
            order[rows] = len(texts) + np.arange(len(rows))
            parts = pa.concat_arrays([parts, own]).take(pa.array(order))
        return parts

    def _encode(self, texts: pa.Array) -> Iterator[bytes]:
        for known, most in ((self.words, MAX_WORDS), (self.pieces, MAX_PIECES)):
            # fresh ones are left by a task that was ended
            if known.fresh or len(known) >= most or len(known.ids) >= MAX_IDS:
                known.forget()
        parts = self._parts(texts)
        edges = parts.offsets.to_numpy() - parts.offsets[0].as_py()
        units = parts.flatten()
        inner = np.ones(len(units), bool)
        inner[edges[:-1]] = False
        heads, many = self._library(units.filter(pa.array(~inner)).to_pylist())
        coded = units.filter(pa.array(inner)).dictionary_encode()
        numbers = self.words.numbers(_strings(coded.dictionary))[coded.indices.to_numpy()]
        counts, begins = np.empty((2, len(units)), np.int64)
        counts[inner], counts[~inner] = self.words.counts[numbers], many
        begins[inner], begins[~inner] = self.words.begins[numbers], len(self.words.ids) + np.cumsum(many) - many
        data = _lists(np.concatenate([self.words.ids, heads]), begins, counts).tobytes()
        cuts = 2 * np.concatenate([[0], np.cumsum(counts)])[edges]
        for low, high in pairwise(cuts.tolist()):
            yield data[low:high]

    def encode_all(self, texts: pa.Array) -> Iterator[bytes]:
        """The ids of each text, null being an empty one."""
        whole = pc.fill_null(texts.cast(pa.large_string()), "")
        upto = np.cumsum(pc.binary_length(whole).to_numpy())
        cuts = [0, *(np.flatnonzero(np.diff(upto // _AT_ONCE)) + 1).tolist(), len(whole)]
        for low, high in pairwise(cuts):
            if high > low:
                yield from self._encode(whole.slice(low, high - low))

    def encode(self, text: str) -> bytes:
        return next(self.encode_all(pa.array([text], pa.large_string())))


@lru_cache(maxsize=1)
def byte_words(path: str) -> ByteWords:
    """One per process, so that the tasks of a worker go on with the words that others before them learned."""
    return ByteWords(path)


class PlainBytes:
    """Ids of whole texts by a byte-level vocabulary in which special tokens' strings are plain text.

    The vocabulary's numbers are the order of its merges, so the faster of the two public libraries
    gives the same ids from them; that one is slow where a text has no white space for long.
    """

    def __init__(self, path: str = BYTE_BPE):
        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        letters = byte_alphabet()
        self.vocabulary = self.library.get_vocab()
        ranks = {bytes(letters[c] for c in t): i for t, i in self.vocabulary.items() if t not in {a.content for a in self.library.get_added_tokens_decoder().values()}}
        self.fast = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> list[int]:
        if len(text) > _STRETCH and (max(map(len, text.split()), default=_STRETCH) >= _STRETCH or any(c * _STRETCH in text for c in " \n\t")):
            return self.library.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


def units(text: str) -> list[str]:
    """What follows the space that each unit of a space and ``text`` begins with, safe for both kinds of tokenizer."""
    if "  " in text or text[:1] == " " or text[-1:] == " " or _ACROSS.search(text):
        return [w if n else w[1:] for n, w in enumerate(_SAFE.split(" " + text))]
    return text.split(" ")
