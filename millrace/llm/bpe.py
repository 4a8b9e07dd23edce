"""Byte-pair encoding by a trie of distinct words, and decoding.

The last token of a word's encoding is a state that each prefix has: a token
``t`` ends the prefix of length n if the prefix without it ends in a token that
``t`` may follow, that is, if merging the two tokens' symbols gives these two
tokens again. There is exactly one such token. Distinct words are put in order,
so that walking through them is a depth-first walk of their trie: states of a
shared prefix stay on the stack and are found once.
"""

from __future__ import annotations

import json
import re
from array import array
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F
from tokenizers import Tokenizer

#: Encoded chunks of text that a worker remembers: so many new ones, and as many that were in use before them.
CACHE_CHUNKS = 250_000
#: Characters of texts that are encoded together.
BATCH_CHARS = 1_000_000
_LONG_CHUNK = 256
#: Letters, digits and case of these code points are alike in every Unicode version in use; the rest goes through the library's own splitter.
_SETTLED = re.compile("[\x00-\x7f\xa1-ɏ]+")
_BLANK = "\t-\r \x85\xa0  -     　"
#: A run of blanks but for its last; a blank and what follows; blanks at the end. No pre-token spans two of these.
_CHUNK = re.compile(f"[{_BLANK}]+(?=[{_BLANK}][^{_BLANK}])|[{_BLANK}]?[^{_BLANK}]+|[{_BLANK}]+")
#: Fixed value: the split pattern of byte-level tokenizers.
_BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Letters, digits and blanks among the settled code points.
_LETTERS, _DIGITS, _BLANKS = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼½¾", r"\t-\r "


def settled_pattern(pattern: str) -> re.Pattern:
    """A split pattern that does the same to texts of settled code points, without properties, which are slow.

    Words come first: the contractions before them begin with another character.
    """
    kinds = {r"[\p{L}]": f"[{_LETTERS}]", r"\p{L}": f"[{_LETTERS}]", r"[\p{N}]": f"[{_DIGITS}]", r"\p{N}": f"[{_DIGITS}]", r"\s": f"[{_BLANKS}]", r"\S": f"[^{_BLANKS}]"}
    pattern = pattern.replace(r"[^\s\p{L}\p{N}]", f"[^{_BLANKS}{_LETTERS}{_DIGITS}]")
    for long, short in kinds.items():
        pattern = pattern.replace(long, short)
    contractions, words, *rest = re.fullmatch(r"((?:'[a-z]+\|)+)([^|]+)\|(.*)", pattern).groups()
    return re.compile("|".join([words, contractions[:-1], *rest]))


def byte_symbols() -> list[str]:
    """The character that stands for each byte: printable ones for themselves, others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in set(plain) else chr(next(rest)) for b in range(256)]


class Merges:
    """The merge table: what a token was merged from, and which tokens may follow each other.

    Words are strings of one character a symbol. Where the tokenizer marks the
    end of a word, the last symbol is another character (``ENDING`` higher).
    """

    ENDING = 0x1000

    def __init__(self, vocab: dict[str, int], merges: list, suffix: str):
        self.suffix, size = suffix, max(vocab.values()) + 1
        self.rank: dict[tuple[int, int], int] = {}
        self.merged: dict[tuple[int, int], int] = {}
        self.parts: list[tuple[int, int, int] | None] = [None] * size
        #: Each token's symbols.
        self.names: list[str] = [""] * size
        pairs = [p.split(" ") if isinstance(p, str) else p for p in merges]
        for name, i in vocab.items():
            if len(name) == 1:
                self.names[i] = name
            elif suffix and name == name[0] + suffix:
                self.names[i] = chr(ord(name[0]) + self.ENDING)
        for n, (left, right) in enumerate(pairs):
            whole, left, right = vocab[left + right], vocab[left], vocab[right]
            self.rank[left, right], self.merged[left, right] = n, whole
            if self.parts[whole] is None:
                self.parts[whole] = left, right, n
                self.names[whole] = self.names[left] + self.names[right]
        self.symbol = {name: i for i, name in enumerate(self.names) if len(name) == 1}
        self._spines: dict[tuple[int, int], list[tuple[int, float]]] = {}
        self._follows: list[dict[int, bool]] = [{} for _ in range(size)]
        self._known = 0
        self._automaton()

    def merge(self, word: str) -> list[int]:
        """Plain merging: the lowest rank first, then the leftmost."""
        tokens = [self.symbol[c] for c in word]
        while len(tokens) > 1:
            n, i = min((self.rank.get(p, 1 << 60), i) for i, p in enumerate(zip(tokens, tokens[1:])))
            if n == 1 << 60:
                break
            tokens[i:i + 2] = [self.merged[tokens[i], tokens[i + 1]]]
        return tokens

    def _automaton(self) -> None:
        """Nodes for the prefixes of all tokens; at each, the tokens that end there, longest first.

        A token that its own symbols don't merge to never ends anything.
        """
        self.next: list[dict[str, int]] = [{}]
        ends: list[int | None] = [None]
        for i, name in enumerate(self.names):
            if not name or (len(name) > 1 and self.merge(name) != [i]):
                continue
            node = 0
            for c in name:
                step = self.next[node].get(c)
                if step is None:
                    step = self.next[node][c] = len(self.next)
                    self.next.append({})
                    ends.append(None)
                node = step
            ends[node] = i
        self.shorter = [0] * len(self.next)
        self.ending: list[tuple[tuple[int, int], ...]] = [()] * len(self.next)
        level = [0]
        while level:
            below = []
            for node in level:
                for c, step in self.next[node].items():
                    if node:
                        at = self.shorter[node]
                        while at and c not in self.next[at]:
                            at = self.shorter[at]
                        self.shorter[step] = self.next[at].get(c, 0)
                    own = () if ends[step] is None else ((ends[step], len(self.names[ends[step]])),)
                    self.ending[step] = own + self.ending[self.shorter[step]]
                    below.append(step)
            level = below

    def _spine(self, token: int, side: int) -> list[tuple[int, float]]:
        """The outer symbols of a token, smallest first, each with the rank of the merge that takes it in."""
        found = self._spines.get((token, side))
        if found is None:
            found, at, taken = [], token, float("inf")
            while True:
                found.append((at, taken))
                parts = self.parts[at]
                if parts is None:
                    break
                at, taken = parts[side], parts[2]
            found.reverse()
            self._spines[token, side] = found
        return found

    def joins(self, first: int, second: int) -> bool:
        """Whether no merge happens across the border of two tokens."""
        left, right, i, j = self._spine(first, 1), self._spine(second, 0), 0, 0
        while True:
            (a, taken_a), (b, taken_b) = left[i], right[j]
            n = self.rank.get((a, b))
            if n is not None and n < taken_a and n <= taken_b:
                return False
            if i == len(left) - 1 and j == len(right) - 1:
                return True
            if j == len(right) - 1 or (i < len(left) - 1 and taken_a <= taken_b):
                i += 1
            else:
                j += 1

    def encode_words(self, words) -> dict[str, bytes]:
        """Every distinct word's ids as unsigned 32-bit numbers."""
        found, before = {}, ""
        # On the stack, for each length: the last token and its length, the answers known for it, the node.
        last, sizes, follows, nodes = [-1], [0], [{}], [0]
        step, shorter, ending, known = self.next, self.shorter, self.ending, self._follows
        for word in sorted(words):
            shared = len(commonprefix(before, word))
            del last[shared + 1:], sizes[shared + 1:], follows[shared + 1:], nodes[shared + 1:]
            node = nodes[shared]
            for end in range(shared + 1, len(word) + 1):
                c = word[end - 1]
                below = step[node].get(c)
                while below is None:
                    if not node:
                        raise ValueError(f"no token has the symbol {c!r}")
                    node = shorter[node]
                    below = step[node].get(c)
                node = below
                for token, size in ending[node]:
                    if size == end:
                        break
                    answers = follows[end - size]
                    fits = answers.get(token)
                    if fits is None:
                        fits = answers[token] = self.joins(last[end - size], token)
                        self._known += 1
                    if fits:
                        break
                else:
                    raise ValueError(f"no token ends {word[:end]!r}")
                last.append(token)
                sizes.append(size)
                follows.append(known[token])
                nodes.append(node)
            ids, at = [], len(word)
            while at:
                ids.append(last[at])
                at -= sizes[at]
            ids.reverse()
            found[word], before = array("I", ids).tobytes(), word
        if self._known > 1_000_000:
            self.forget()
        return found

    def forget(self) -> None:
        """Let go of the answers on which tokens may follow each other."""
        for answers in self._follows:
            answers.clear()
        self._known = 0


def commonprefix(a: str, b: str) -> str:
    """The longest common prefix."""
    n, most = 0, min(len(a), len(b))
    while n < most and a[n] == b[n]:
        n += 1
    return a[:n]


class Encoder:
    """A tokenizer file of the byte-level BPE kind, with texts in and ids out as its library does.

    New words are encoded by the trie, or without ``trie`` by the library's own merging.
    """

    def __init__(self, path: str, trie: bool = True):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        model, before = spec["model"], spec["pre_tokenizer"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.merges = Merges(model["vocab"], model["merges"], self.suffix) if trie else None
        self.special = {t["content"]: array("I", [t["id"]]).tobytes() for t in spec["added_tokens"]}
        self.specials = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        symbols = byte_symbols()
        self.symbols, self.blank = dict(enumerate(symbols)), symbols[32]
        back = {s: bytes([b]) for b, s in enumerate(symbols)}
        named = [*model["vocab"].items(), *((t["content"], t["id"]) for t in spec["added_tokens"])]
        self.token_bytes = [b""] * (max(i for _, i in named) + 1)
        for token, i in named:
            self.token_bytes[i] = b"".join(back[c] for c in token) if all(c in back for c in token) else token.encode()
        split = [p for p in before.get("pretokenizers", []) if p["type"] == "Split"]
        self.lower = any(n["type"] == "Lowercase" for n in (spec["normalizer"] or {}).get("normalizers", []))
        #: Blanks are dropped by the pre-tokenizer.
        self.drops_blanks = bool(split)
        pattern = split[0]["pattern"]["Regex"] if split else _BYTE_LEVEL
        self.split, self.settled_split = regex.compile(pattern).findall, settled_pattern(pattern).findall
        self.cache: dict[str, bytes] = dict(self.special)
        self.older: dict[str, bytes] = {}

    def chunks(self, text: str) -> list[str]:
        """Pieces of a text without special tokens that can be encoded alone."""
        return text.replace("\n", " ").split(" ") if self.drops_blanks else _CHUNK.findall(text)

    def _symbols(self, word: str) -> str:
        """A pre-token in byte symbols."""
        if word.isascii() and word.isprintable():
            word = word.replace(" ", self.blank)
        else:
            word = word.encode().decode("latin-1").translate(self.symbols)
        return self._ended(word)

    def _ended(self, word: str) -> str:
        """A pre-token with its end marked where the trie's tokenizer marks ends; the library does so itself."""
        return word[:-1] + chr(ord(word[-1]) + Merges.ENDING) if self.suffix and self.merges else word

    def words(self, chunk: str) -> list[str]:
        """The pre-tokens of a chunk, in byte symbols."""
        if _SETTLED.fullmatch(chunk):
            return list(map(self._symbols, self.split(chunk.lower() if self.lower else chunk)))
        if self.library.normalizer is not None:
            chunk = self.library.normalizer.normalize_str(chunk)
        return [self._ended(w) for w, _ in self.library.pre_tokenizer.pre_tokenize_str(chunk)]

    def _encode_words(self, words: set[str]) -> dict[str, bytes]:
        """Every distinct pre-token's ids."""
        if self.merges:
            return self.merges.encode_words(words)
        tokens = self.library.model.tokenize
        return {w: array("I", [t.id for t in tokens(w)]).tobytes() for w in words}

    def _pieces(self, text: str, words: list[list[str]], chunks: list[list[str]]) -> list[str]:
        """What of a text without special tokens is looked up: its words if all characters are settled, else its chunks."""
        small = text.lower() if self.lower else text
        if _SETTLED.fullmatch(text) and (small is text or _SETTLED.fullmatch(small)):
            words.append(self.settled_split(small))
            return words[-1]
        chunks.append(self.chunks(text))
        return chunks[-1]

    def _learn(self, plain: set[str], chunks: set[str]) -> None:
        """Put the ids of words of settled characters, and of chunks, in the cache."""
        symbols = dict(zip(plain, map(self._symbols, plain)))
        split = {chunk: self.words(chunk) for chunk in chunks}
        ids = self._encode_words({*symbols.values(), *chain.from_iterable(split.values())})
        self.cache.update(zip(symbols, map(ids.__getitem__, symbols.values())))
        for chunk, words in split.items():
            self.cache[chunk] = b"".join([ids[w] for w in words])

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as unsigned 32-bit numbers; none for NULL."""
        found, begin = [], 0
        while begin < len(texts):
            end, chars = begin, 0
            while end < len(texts) and (end == begin or chars < BATCH_CHARS):
                chars += len(texts[end] or "")
                end += 1
            cut, words, chunks = [], [], []
            for text in texts[begin:end]:
                text, pieces, at = text or "", [], 0
                for m in self.specials.finditer(text) if self.specials else ():
                    pieces += [*self._pieces(text[at:m.start()], words, chunks), m[0]]
                    at = m.end()
                cut.append(pieces + self._pieces(text[at:], words, chunks) if at else self._pieces(text, words, chunks))
            plain, mixed = set().union(*words), set().union(*chunks)
            mixed -= plain
            new = (plain | mixed) - self.cache.keys()
            if len(self.cache) + len(new) > CACHE_CHUNKS:
                self.cache, self.older = dict(self.special), self.cache
                new = (plain | mixed) - self.special.keys()
            known = self.older.keys() & new
            self.cache.update({c: self.older[c] for c in known})
            new -= known
            self._learn(new & plain, new & mixed)
            get = self.cache.__getitem__
            found += [b"".join(map(get, pieces)) for pieces in cut]
            for piece in new:
                if len(piece) > _LONG_CHUNK:
                    del self.cache[piece]
            begin = end
        return found

    def forget(self) -> None:
        """Let go of all that was remembered of texts; it is found anew when needed."""
        self.cache, self.older = dict(self.special), {}
        if self.merges:
            self.merges.forget()

    def decode(self, ids) -> str:
        return b"".join(map(self.token_bytes.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(maxsize=4)
def encoder(path: str, trie: bool = True) -> Encoder:
    """The worker's encoder for a file; it lives as long as the worker."""
    return Encoder(path, trie)


def encode(text: Column, path: str) -> Column:
    """The ids of a text (``array<int>``), special tokens' strings included.

    ``path`` names a byte-level BPE tokenizer file that every executor has.
    NULL and empty texts have no ids. Texts of any length are encoded whole.
    """

    @F.arrow_udf("array<int>")
    def ids(texts: pa.Array) -> pa.Array:
        each = encoder(path).encode(texts.to_pylist())
        offsets = np.concatenate([[0], np.cumsum([len(b) // 4 for b in each], dtype=np.int64)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(each), np.int32)))

    return ids(text)


def decode(ids: Column, path: str) -> Column:
    """The text of ids; bytes that aren't UTF-8 become U+FFFD, NULL and no ids the empty text."""

    @F.arrow_udf("string")
    def text(lists: pa.Array) -> pa.Array:
        engine, values, ends = encoder(path), lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
        return pa.array([engine.decode(values[a:b].tolist()) for a, b in zip(ends, ends[1:])], pa.string())

    return text(ids)
