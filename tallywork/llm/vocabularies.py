"""Vocabulary files as bounded values that tasks can carry, and the piece caches of the token operators.

A vocabulary file is read once on the driver and broadcast (a few MB whatever the data), so executors need no copy of it.
"""

from __future__ import annotations

import base64
import json
import re
from array import array
from collections.abc import Callable

from pyspark import Broadcast
from pyspark.sql import SparkSession

_built: dict[tuple, object] = {}


def broadcast_file(spark: SparkSession, path: str) -> Broadcast:
    """The bytes of a vocabulary file."""
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast(file.read())


def once(key: tuple, build):
    """One value per Python worker and key; workers live on between tasks."""
    if key not in _built:
        _built[key] = build()
    return _built[key]


def dismiss() -> bool:
    """Forget the values of ``once``, and say whether there were any; the next task that asks builds them again."""
    held = bool(_built)
    _built.clear()
    return held


#: Pieces longer than this are encoded each time; caches of pieces are bounded in bytes by it.
LONG = 64


class Recent(dict):
    """A bounded cache of pieces: asked for one that it lacks, it computes the value.

    What was used since the last half of the limit was filled stays when the older half is dropped. Long pieces, such as whole
    texts of languages without blanks, are not kept.
    """

    def __init__(self, compute: Callable, limit: int):
        super().__init__()
        self.compute, self.half, self.older = compute, max(1, limit // 2), {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.compute(key)
        if len(key) > LONG:
            return value
        if len(self) >= self.half:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


def read_ranks(raw: bytes) -> dict[bytes, int]:
    """Token bytes to rank, from a rank file."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, raw.splitlines())}


def _byte_letters() -> dict[int, str]:
    """The printable letter that byte-level vocabularies write for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


#: A run of Latin letters and then common punctuation: what most pieces of a text are. Every
#: Unicode version has these as letters, so they are split the same by all libraries.
SIMPLE = re.compile(r"([A-Za-zÀ-ÖØ-öø-ɏ]+)([.,;:!?]?)")
_SPACE_AFTER_SPACE = re.compile(r"\s ")
_CUT_BEFORE_SPACE = re.compile(r"(?<=\S)(?= )")


class Vocabulary:
    """A ``tokenizers`` vocabulary with the tricks that make single pieces cheap.

    ``ids_of(piece)`` gives the library's ids. A piece of letters and one mark is looked up as
    its letters and the mark, so that each stem goes through the merges once, by the library's own model.
    """

    def __init__(self, raw: bytes, limit: int):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(raw.decode("utf-8"))
        self.library.no_truncation()
        self.library.no_padding()
        self.markers = {t.content[:2].lower() for t in self.library.get_added_tokens_decoder().values() if t.content}
        spec = json.loads(raw)
        self.lower = "Lowercase" in json.dumps(spec.get("normalizer"))
        self.letters = str.maketrans(_byte_letters())
        self.stems = Recent(self._stem, limit)
        self.marks: dict[str, bytes] = {"": b""}

    def special(self, text: str) -> bool:
        """Whether the text may hold a special string; it then goes to the library as a whole."""
        low = text.lower() if self.lower else text
        return any(marker in low for marker in self.markers)

    def whole(self, text: str) -> bytes:
        """The library's ids of a text, as native 32-bit numbers."""
        return array("I", self.library.encode(text, add_special_tokens=False).ids).tobytes()

    def _stem(self, stem: str) -> bytes:
        spelled = stem.encode("utf-8").decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.library.model.tokenize(spelled)]).tobytes()

    def ids_of(self, piece: str) -> bytes:
        """The ids of a piece, as native 32-bit numbers."""
        space = " " if piece[:1] == " " else ""
        simple = SIMPLE.fullmatch(piece, len(space))
        if simple is None:
            return self.whole(piece)
        letters, mark = simple.groups()
        stem = letters.lower() if self.lower else space + letters
        if self.lower and len(stem) != len(letters):
            return self.whole(piece)
        if mark not in self.marks:
            self.marks[mark] = self.whole(mark)
        return self.stems[stem] + self.marks[mark]


def spaced_pieces(text: str) -> list[str]:
    """The text cut before each blank that follows something other than white space.

    Byte-level patterns always end a match there, so the pieces can be encoded one by one.
    """
    if _SPACE_AFTER_SPACE.search(text):
        return _CUT_BEFORE_SPACE.split(text)
    first, *rest = text.split(" ")
    return ([first] if first else []) + [" " + piece for piece in rest]
