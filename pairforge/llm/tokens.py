"""Token ids of whole texts by a tokenizers file, one word at a time.

Both supported vocabularies cut a text at white space before they merge, so the
ids of a text are the ids of its words in order.  A worker keeps the words
met lately with the little-endian bytes of their ids; the pieces of a new word
are looked up likewise, and a new piece is merged by the library's model.
Where the vocabulary drops white space, plain texts are cut together as one array
of bytes, and each distinct piece of them is looked up once.
"""

from __future__ import annotations

import codecs
import os
import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa

#: White space as the vocabularies' own patterns see it (Unicode White_Space).
SPACE = "\t\n\x0b\x0c\r \x85\xa0     　" + "".join(map(chr, range(0x2000, 0x200B)))
_WORDS = re.compile(f"[^{SPACE}]+")
_SPACED = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
#: What str.split() takes for white space and the patterns do not.
_ODD = re.compile("[\x1c-\x1f]")
_SPECIAL_SPACE = re.compile(f"[{SPACE}]")

#: Words kept per worker and generation; two generations are alive at most.
KEPT_WORDS = 400_000


def load(path: str):
    """The library's tokenizer, on one thread (Spark runs the others)."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def bare_words(text: str) -> list[str]:
    """Words without the white space around them."""
    return _WORDS.findall(text) if _ODD.search(text) else text.split()


def spaced_words(text: str) -> list[str]:
    """Words with the white space before them; white space at the end alone."""
    return _SPACED.findall(text)


class WordMemo(dict):
    """Word -> value, for the words met lately.

    ``many`` gives the values of a list of unknown words.  When the memo is full
    it becomes the old generation; words found there move on to the new one.
    """

    def __init__(self, many: Callable[[list[str]], list]):
        super().__init__()
        self.many, self.old = many, {}

    def turn(self) -> None:
        """A new generation, if this one is full."""
        if len(self) > KEPT_WORDS:
            self.old = dict(self)
            self.clear()

    def learn(self, texts: list[list[str]]) -> None:
        self.turn()
        words = [w for w in set().union(*texts) if w not in self]
        if self.old:
            self.update({w: self.old[w] for w in words if w in self.old})
            words = [w for w in words if w not in self.old]
        for at in range(0, len(words), 4096):
            part = words[at : at + 4096]
            self.update(zip(part, self.many(part), strict=True))


class PieceMemo(WordMemo):
    """A memo that finds the value of an unknown word when it is asked for: words
    that need no company are not gathered first."""

    def __init__(self, one: Callable[[str], object]):
        super().__init__(lambda words: list(map(one, words)))
        self.one = one

    def learn(self, texts: list[list[str]]) -> None:
        self.turn()

    def __missing__(self, word: str):
        value = self.old.get(word)
        self[word] = value = self.one(word) if value is None else value
        return value


_LATIN = "\xc0-\xd6\xd8-\xf6\xf8-\xff"
#: Texts whose normal form and pieces need no Unicode tables.
_SHORT = "'s|'t|'re|'ve|'m|'ll|'d|"
_PLAIN_TEXT = re.compile(f"[\\n -~{_LATIN}]*").fullmatch
_PLAIN_DROPPED = re.compile(f"{_SHORT}[a-z{_LATIN}]+|[0-9]|[^\\sa-z0-9{_LATIN}]+").findall
# the most frequent first: what begins with a letter or a space is no short form
_PLAIN_SPACED = re.compile(f" ?[A-Za-z{_LATIN}]+|{_SHORT} ?[0-9]+| ?[^\\sA-Za-z0-9{_LATIN}]+|\\s+(?!\\S)|\\s+").findall

#: Bytes of a plain text in lower case: letters, digits, white space and the rest.
_LETTER, _DIGIT, _BLANK, _REST = range(4)
_KIND = np.full(256, _REST, np.uint8)
_KIND[ord("a") : ord("z") + 1] = _KIND[0x80:] = _LETTER
_KIND[ord("0") : ord("9") + 1] = _DIGIT
_KIND[[ord("\n"), ord(" ")]] = _BLANK


def dropped_pieces(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What ``_PLAIN_DROPPED`` finds in a plain text in lower case, as (starts, lengths,
    the bytes of all pieces one after the other)."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), data
    kind = _KIND[data]
    first = np.concatenate([[True], kind[1:] != kind[:-1]]) | (kind == _DIGIT)
    # an apostrophe that begins a run of the rest may begin a short form
    mark = np.flatnonzero(data == ord("'"))
    mark = mark[first[mark]]
    one, two = (np.append(data, [0, 0])[mark + i] for i in (1, 2))
    size = 2 * np.isin(one, list(b"stmd"))
    size[((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))] = 3
    mark, size = mark[size > 0], size[size > 0]
    first[mark + 1] = False
    after = mark + size
    first[after[after < len(data)]] = True
    starts = np.flatnonzero(first)
    lengths = np.diff(starts, append=len(data))
    piece = kind[starts] != _BLANK
    return starts[piece], lengths[piece], data[kind != _BLANK]


def _byte_characters() -> str:
    """The printable stand-in of each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return "".join(chr(b if b in shown else 256 + rest.index(b)) for b in range(256))


class Pieces:
    """Words to the pieces that the vocabulary merges within.

    Plain texts are cut here; the words of all others by the library's own
    normalizer and pre-tokenizer.  A special string is a piece by itself, marked by a leading
    NUL (its id is fixed; it is not merged).
    """

    def __init__(self, path: str):
        self.tokenizer = load(path)
        before, cut = str(self.tokenizer.normalizer), str(self.tokenizer.pre_tokenizer)
        self.dropped = "Removed" in cut
        if self.dropped != ("Lowercase" in before) or (not self.dropped and "use_regex=True" not in cut):
            raise ValueError("words of this vocabulary are not known to stand alone")
        self.words = bare_words if self.dropped else spaced_words
        self.shown = _byte_characters()
        self.special = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        for token in self.tokenizer.get_added_tokens_decoder().values():
            if _SPECIAL_SPACE.search(token.content) or token.lstrip or token.rstrip or token.single_word:
                raise ValueError("a special token reaches beyond its word")
        marks = [c for c in min(self.special, key=len, default="\0") if all(c in t for t in self.special)]
        if not marks:
            raise ValueError("the special strings share no character to look for")
        self.mark = marks[0]
        self._special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")

    def plain(self, text: str) -> list[str] | None:
        """The pieces of a plain text, spelt as in the text (lower case where the
        vocabulary has it); None for any other text."""
        if not self.is_plain(text):
            return None
        return _PLAIN_DROPPED(text.lower()) if self.dropped else _PLAIN_SPACED(text)

    def is_plain(self, text: str) -> bool:
        return bool(_PLAIN_TEXT(text)) and not (self.mark in text and self._special.search(text))

    def spelt(self, piece: str) -> str:
        """A plain piece in the stand-in characters of its bytes."""
        return codecs.charmap_decode(piece.encode(), "strict", self.shown)[0]

    def of(self, word: str) -> list[str]:
        if self.mark in word:
            parts = self._special.split(word)
            if len(parts) > 1:
                return [p for i, part in enumerate(parts) for p in (["\0" + part] if i % 2 else self.of(part) if part else [])]
        whole = self.tokenizer
        return [p for p, _ in whole.pre_tokenizer.pre_tokenize_str(whole.normalizer.normalize_str(word) if whole.normalizer else word)]


class WordEncoder:
    """Texts to little-endian unsigned 32-bit ids, equal to what the library's
    ``encode(text, add_special_tokens=False)`` gives.

    Special strings inside texts become their ids, as is the library's default.
    A vocabulary whose special strings hold white space is refused.
    """

    def __init__(self, path: str):
        self.pieces = Pieces(path)
        self.model = self.pieces.tokenizer.model
        self.id_bytes = [i.to_bytes(4, "little") for i in range(self.pieces.tokenizer.get_vocab_size())]
        self.piece_ids = PieceMemo(self._piece)
        self.memo = WordMemo(self._many)
        self.plain = PieceMemo(self._plain)

    def _piece(self, piece: str) -> bytes:
        if piece[0] == "\0":
            return self.pieces.special[piece[1:]].to_bytes(4, "little")
        known = self.id_bytes
        return b"".join([known[t.id] for t in self.model.tokenize(piece)])

    def _plain(self, piece: str) -> bytes:
        known = self.id_bytes
        return b"".join([known[t.id] for t in self.model.tokenize(self.pieces.spelt(piece))])

    def _many(self, words: list[str]) -> list[bytes]:
        cut = [self.pieces.of(w) for w in words]
        self.piece_ids.learn(cut)
        get = self.piece_ids.__getitem__
        return [b"".join(map(get, p)) for p in cut]

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.pieces.dropped:
            return by_pieces(texts, self.pieces, self.plain, self.memo, b"".join)
        found: list[bytes | None] = [None] * len(texts)
        at = [i for i, t in enumerate(texts) if self.pieces.is_plain(t)]
        for i, ids in zip(at, self._dropped([texts[i] for i in at]), strict=True):
            found[i] = ids
        return by_words(found, texts, self.pieces, self.memo, b"".join)

    def _dropped(self, texts: list[str]) -> list[bytes]:
        """The ids of plain texts, if the vocabulary drops white space."""
        raw = [t.lower().encode() for t in texts]
        ends = np.cumsum([len(t) + 1 for t in raw], dtype=np.int64)
        starts, lengths, data = dropped_pieces(np.frombuffer(b"\n".join(raw), np.uint8))
        places = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
        words = pa.StringArray.from_buffers(len(starts), pa.py_buffer(places), pa.py_buffer(data)).dictionary_encode()
        self.plain.turn()
        ids = pa.array(list(map(self.plain.__getitem__, words.dictionary.to_numpy(zero_copy_only=False).tolist())), pa.large_binary()).take(words.indices)
        _, borders, content = ids.buffers()
        borders = np.frombuffer(borders, np.int64)[: len(ids) + 1] if len(ids) else np.zeros(1, np.int64)
        cuts = borders[np.concatenate([[0], np.searchsorted(starts, ends)])].tolist()
        held = memoryview(content) if content else b""
        return [bytes(held[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


_KEPT: dict[tuple[str, float], WordEncoder] = {}


def kept_encoder(path: str) -> WordEncoder:
    """The encoder of a tokenizers file.  A worker keeps the last one, with the words
    it met, for the tasks that follow."""
    key = path, os.path.getmtime(path)
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = WordEncoder(path)
    return _KEPT[key]


def by_pieces(texts: list[str], pieces: Pieces, plain: PieceMemo, words: WordMemo, total: Callable) -> list:
    """For each text, ``total`` over the values of its plain pieces, or of its
    words where it isn't plain.  The pieces of one text are looked up before the
    next is cut, so that few are held at once."""
    plain.turn()
    found, get = [], plain.__getitem__
    for t in texts:
        cut = pieces.plain(t)
        found.append(None if cut is None else total(map(get, cut)))
    return by_words(found, texts, pieces, words, total)


def by_words(found: list, texts: list[str], pieces: Pieces, words: WordMemo, total: Callable) -> list:
    """``found``, filled up where it is None: ``total`` over the values of the words."""
    other = {at: pieces.words(texts[at]) for at, value in enumerate(found) if value is None}
    words.learn(list(other.values()))
    for at, cut in other.items():
        found[at] = total(map(words.__getitem__, cut))
    return found
