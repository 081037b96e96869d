"""Given tokenizers inside tasks.

Natural text repeats its words, and a tokenizer's work on a word does not depend on the words around it as long as
a single space lies between. So texts are cut at such spaces, and each distinct part is encoded once per task, as if it
followed a space. What says that a tokenizer allows it, ``byte_level`` and ``sentence_pieces``, looks at its rules; where
they don't, a text is one part.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable
from functools import lru_cache

import numpy as np

#: A single space between two visible characters, and a space that isn't.
CUT = re.compile(r"(?<=[!-~\w]) (?=[!-~\w])")
OTHER = re.compile(r" (?:(?![!-~\w])|(?<=[^!-~\w] ))")
VISIBLE = frozenset(map(chr, range(0x21, 0x7F)))
TOGETHER = 200  # parts that are encoded as one text
#: A line end that does not stand between two visible characters, and marks that are parted from a letter or digit before them.
LOOSE = re.compile(r"\n(?![!-~\w])|(?<![!-~\w])\n")
MARKS = frozenset(",.;:!?")
LONGEST = 64  # characters of a part that is worth remembering
#: Bytes by what they are next to a space: visible, of a character beyond ASCII, or neither; letters and digits; and MARKS.
NEITHER, SEEN, BEYOND = 0, 1, 2
NEXT_TO = np.array([SEEN if 0x20 < b < 0x7F else BEYOND if b > 0x7F else NEITHER for b in range(256)], np.uint8)
ASCII_ALNUM = np.array([chr(b).isalnum() and b < 0x80 for b in range(256)])
IS_MARK = np.array([chr(b) in MARKS for b in range(256)])


def parts_of(text: str) -> list[str]:
    """A text cut at single spaces between visible characters; the spaces belong to neither part."""
    return CUT.split(text) if text[:1] == " " or OTHER.search(text) else text.split(" ")


def whole(text: str) -> list[str]:
    return [text]


class Remembered:
    """What ``encode`` makes of parts, which it is given many at a time.

    Up to ``held`` parts of two generations stay, and those that are met again stay longer, so frequent ones are encoded once.
    """

    def __init__(self, encode: Callable[[list], list], held: int = 100_000):
        self.encode, self.held = encode, held
        self.young: dict[str | bytes, object] = {}
        self.old: dict[str | bytes, object] = {}

    def of(self, texts: list[list]) -> list[list]:
        """What each part of each text becomes, in order."""
        if len(self.young) > self.held:
            self.young, self.old = {}, self.young
        young, old = self.young, self.old
        # Most parts are known: they are looked up once, and only the others a second time.
        out = [list(map(young.get, parts)) for parts in texts]
        holes = [[k for k, x in enumerate(found) if x is None] for found in out]
        new = []
        for part in {parts[k] for parts, places in zip(texts, holes, strict=True) for k in places}.difference(young):  # which may hold None
            found = old.get(part)
            if found is not None:
                young[part] = found
            else:
                new.append(part)
        young.update(zip(new, self.encode(new), strict=True))
        for parts, found, places in zip(texts, out, holes, strict=True):
            for k in places:
                found[k] = young[parts[k]]
        for part in new:
            if len(part) > LONGEST:
                del young[part]
        return out


def divided_words(part: str) -> list[str]:
    """A part of words and line ends, as byte-level rules divide it: before a line end, and before a last mark of punctuation.

    A piece that begins with a line end follows no space, nor does one that is a single mark after ``\\0``.
    """
    if "\n" not in part:
        return [part[:-1], f"\0{part[-1]}"] if part[-1:] in MARKS and part[-2:-1].isalnum() else [part]
    lines = [part] if LOOSE.search(part) else part.split("\n")
    out = []
    for k, line in enumerate(lines):
        bare = f"\n{line}" if k else line
        if line[-1:] in MARKS and line[-2:-1].isalnum():
            out += [bare[:-1], f"\0{line[-1]}"]
        else:
            out.append(bare)
    return out


@lru_cache(maxsize=1)
def _alnum() -> np.ndarray:
    """Whether a character is a letter or digit, by its number."""
    return np.fromiter((chr(c).isalnum() for c in range(0x110000)), bool, 0x110000)


def _characters(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The numbers of the characters beyond ASCII whose first bytes lie at ``at``."""
    first = data[at].astype(np.int64)
    more = 1 + (first >= 0xE0) + (first >= 0xF0)
    out = first & (0x3F >> more)
    for k in range(1, 4):
        out = np.where(k <= more, out << 6 | data[np.minimum(at + k, len(data) - 1)] & 0x3F, out)
    return out


def piece_begins(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where pieces of texts begin whose ids do not depend on what stands around them, by byte-level rules, and the end of the last.

    ``data`` has the UTF-8 bytes of all texts, each from one of ``starts`` to the next. A piece begins with a single space or line end between visible
    characters, or is a mark of punctuation between an ASCII letter or digit and one of these; and with each text that is not empty.
    """
    begin = np.zeros(len(data) + 1, bool)
    begin[starts] = True
    at = np.flatnonzero((data == 0x20) | (data == 0x0A))
    at = at[~(begin[at] | begin[at + 1])]  # inside its text
    before, after = NEXT_TO[data[at - 1]], NEXT_TO[data[at + 1]]
    sure = (before != NEITHER) & (after != NEITHER)
    odd = np.flatnonzero(sure & (after == BEYOND))
    sure[odd] = _alnum()[_characters(data, at[odd] + 1)]
    odd = np.flatnonzero(sure & (before == BEYOND))
    first = at[odd] - 1
    for _ in range(3):
        first -= (data[first] & 0xC0) == 0x80
    sure[odd] = _alnum()[_characters(data, first)]
    at = at[sure]
    marks = at - 1
    marks = marks[IS_MARK[data[marks]] & ASCII_ALNUM[data[marks - 1]] & ~begin[marks]]
    begin[at] = begin[marks] = True
    return np.flatnonzero(begin)


def whole_begins(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The same where each text is one piece."""
    return np.unique(starts)


def part_of(piece: str) -> str:
    """A piece as ``SpacedParts`` takes it: without its space, as it begins with a line end, or after ``\\0``."""
    after = piece[1:2]
    return piece[1:] if piece[0] == " " and (after in VISIBLE or after.isalnum()) else piece if piece[0] == "\n" else f"\0{piece}"


def _stands_apart(part: str) -> bool:
    """Whether a part can stand between others, after a space each, without a tokenizer seeing them."""
    return bool(part) and all(c in VISIBLE or c.isalnum() for c in (part[0], part[-1]))


@lru_cache(maxsize=4)
def byte_level(path: str, specials_as_text: bool):
    """A tokenizer from a file of the tokenizers library, and how to cut texts for it."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark has a task for every core
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = specials_as_text
    told = json.loads(tokenizer.to_str())
    before = told["pre_tokenizer"] or {}
    plain = told["normalizer"] is None and told["truncation"] is None and told["padding"] is None and told["model"].get("dropout") is None
    cut = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before["add_prefix_space"]
    added = all(" " not in a["content"] and not (a["lstrip"] or a["rstrip"] or a["single_word"]) for a in told["added_tokens"])
    return tokenizer, parts_of if plain and cut and added else whole


class SpacedParts:
    """Encodes parts as they stand after a space, for a tokenizer whose texts can be cut.

    Parts that can stand next to each other are encoded as one text, which costs less than one by one; the bytes that
    their ids stand for tell them apart again. Words of letters alone go to the same model without the rules that would
    find them in a text. With ``pieces``, parts may be pieces of ``divided_words``; the parts of a text after its first never begin like these.
    """

    def __init__(self, path: str, specials_as_text: bool, kind: np.dtype = np.dtype(np.uint32), pieces: bool = False):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer, _ = byte_level(path, specials_as_text)
        self.sizes = np.array([len(x) for x in byte_level_bytes(path, specials_as_text)], np.int64)
        self.kind, self.pieces = kind, pieces
        self.words = Tokenizer(self.tokenizer.model)
        self.words.pre_tokenizer = pre_tokenizers.CharDelimiterSplit("\n")  # which no word holds
        self.written = str.maketrans({chr(b): c for c, b in byte_alphabet().items()} | {"\n": "\n"})

    def __call__(self, parts: list[str]) -> list[bytes]:
        """The ids of each part, as numbers of ``kind``."""
        out: list = [None] * len(parts)
        letters, others = [], []
        for k, part in enumerate(parts):
            if part.isalpha():
                letters.append(k)
            elif _stands_apart(part.removeprefix("\n") if self.pieces else part):
                others.append(k)
        for some, tokenizer, as_text in ((letters, self.words, self._as_words), (others, self.tokenizer, "".join)):
            groups = [some[i : i + TOGETHER] for i in range(0, len(some), TOGETHER)]
            spaced = [[self._placed(parts[k]) for k in group] for group in groups]
            for group, texts, found in zip(groups, spaced, tokenizer.encode_batch_fast(list(map(as_text, spaced)), add_special_tokens=False), strict=True):
                self._share(out, group, texts, found.ids)
        alone = [k for k, x in enumerate(out) if x is None]
        texts = [self._placed(parts[k]) for k in alone]
        for k, found in zip(alone, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False), strict=True):
            out[k] = np.array(found.ids, self.kind).tobytes()
        return out

    def _placed(self, part: str) -> str:
        return part.removeprefix("\0") if self.pieces and part[0] in "\n\0" else f" {part}"

    def _as_words(self, texts: list[str]) -> str:
        return "\n".join(texts).encode().decode("latin-1").translate(self.written)

    def _share(self, out: list, group: list[int], texts: list[str], found: list[int]) -> None:
        """Give each part of a group its ids, if their bytes end where the parts do."""
        ids = np.array(found, np.uint32)
        ends = np.cumsum(self.sizes[ids])
        stops = np.cumsum([len(t) if t.isascii() else len(t.encode()) for t in texts])
        at = np.minimum(np.searchsorted(ends, stops), len(ends) - 1)
        if len(ends) and ends[-1] == stops[-1] and (ends[at] == stops).all():
            cuts = ((at + 1) * self.kind.itemsize).tolist()
            data = ids.astype(self.kind).tobytes()
            for k, a, b in zip(group, [0, *cuts], cuts, strict=False):
                out[k] = data[a:b]


@lru_cache(maxsize=4)
def sentence_pieces(path: str):
    """A processor from a file of the sentencepiece library, and how to cut texts for it."""
    import sentencepiece

    processor = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = (processor.id_to_piece(i) for i in range(processor.get_piece_size()))
    # No piece goes on after a space, so parts never share one.
    return processor, whole if any(re.search("[^\u2581]\u2581", p) for p in pieces) else parts_of


def byte_alphabet() -> dict[str, int]:
    """The characters by which byte-level vocabularies write bytes: visible ones of Latin-1 as they are, the others from U+0100 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + k): b for k, b in enumerate(hidden)}


@lru_cache(maxsize=4)
def byte_level_bytes(path: str, specials_as_text: bool) -> list[bytes]:
    """The bytes of each id; an added token stands for its own text."""
    tokenizer, _ = byte_level(path, specials_as_text)
    of = byte_alphabet()
    added = {i: t.content.encode() for i, t in tokenizer.get_added_tokens_decoder().items()}
    names = {i: token for token, i in tokenizer.get_vocab().items()}
    return [added[i] if i in added else bytes(of[c] for c in names.get(i, "")) for i in range(max(names) + 1)]


@lru_cache(maxsize=4)
def piece_bytes(path: str) -> list[bytes]:
    """The bytes of each piece: U+2581 is a space, <0xHH> a byte."""
    processor, _ = sentence_pieces(path)
    out = []
    for i in range(processor.get_piece_size()):
        piece = processor.id_to_piece(i)
        out.append(bytes([int(piece[3:5], 16)]) if processor.is_byte(i) else piece.replace("\u2581", " ").encode())
    return out
