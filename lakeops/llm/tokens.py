"""Token ids from a vocabulary file of the tokenizers library, with caches of bounded size."""

from __future__ import annotations

import json
import os
import re

import numpy as np
from tokenizers import Tokenizer

from lakeops.llm.bpe import byte_letters
from lakeops.llm.common import kept as kept_object

#: Bytes that a worker process keeps of encoded words and pieces of texts.
CACHE_BYTES = 64 << 20
#: Longer words are not kept. What an entry takes besides its letters and ids.
LONGEST, ENTRY = 64, 160
#: Letters of a text whose words are held at once.
BLOCK = 1 << 18

# Fixed value: the pattern by which the file's model splits words, without its special tokens.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Text of ASCII and the letters of Latin-1; and the same pattern for it, which splits it alike.
_PLAIN = re.compile("[\t-\r\x20-\x7eÀ-ÖØ-öø-ÿ]*")
_WORDS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\\sa-z0-9ß-öø-ÿ]+")
#: A word of letters in lower case, and signs that often follow one and are a word of their own there.
_LETTERS, _MARKS = re.compile("[a-zß-öø-ÿ]+"), frozenset(b"%c" % c for c in b".,;:!?")
#: A place where a text may be cut: ASCII white space, at which ``bytes.split`` cuts as well.
_GAP = re.compile("[\t-\r ]")


class _Asking(dict):
    """Asks ``find`` for what it does not hold."""

    def __init__(self, find):
        self.find = find

    def __missing__(self, key):
        return self.find(key)


class Kept:
    """A dictionary of bounded size: what was not asked for in a long time goes.

    With ``make``, ``new`` answers for every key: what it lacks comes from the old half or is
    made, and stays unless its key is long.
    """

    def __init__(self, most: int, make=None):
        self.most, self.size, self.make = most // 2, 0, make
        self.new: dict = _Asking(self.find)
        self.old: dict = {}

    def missing(self, keys) -> list:
        """The keys that are in neither half; those of the old half move to the new one."""
        out, new, old = [], self.new, self.old
        for k in [k for k in keys if k not in new]:
            found = old.get(k)
            if found is None:
                out.append(k)
            else:
                self.add(k, found)
        return out

    def add(self, key, value: bytes) -> None:
        self.new[key] = value
        self.size += len(key) + len(value) + ENTRY

    def find(self, key) -> bytes:
        found = self.old.get(key)
        if found is None:
            found = self.make(key)
        if len(key) <= LONGEST:
            self.add(key, found)
        return found

    def tidy(self) -> None:
        """Call when no looked-up key is needed any more."""
        if self.size > self.most:
            self.old, self.new, self.size = self.new, _Asking(self.find), 0


def _blocks(text: str):
    """A long text in parts, cut at white space."""
    at = 0
    while len(text) - at > BLOCK:
        gap = _GAP.search(text, at + BLOCK)
        if not gap:
            break
        yield text[at : gap.start()]
        at = gap.start()
    yield text[at:] if at else text


class PieceEncoder:
    """Encodes texts as ``Tokenizer.encode`` does without special tokens added.

    Where the file's model drops white space and never looks across words, texts are cut at
    ASCII white space, and each piece, and each word of it in lower case, is encoded once as
    long as it is kept. Pieces of letters beyond ASCII and Latin-1 count as a word. Other
    models get whole texts. Ids are little-endian unsigned integers of 16 bits if the
    vocabulary allows, else 32.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.dtype = _id_type(spec)
        self.cuts = _forgets_space(spec)
        self.kept = Kept(CACHE_BYTES, self._piece)
        self.model = self.tokenizer.model
        self.id_bytes = [np.array([i], self.dtype).tobytes() for i in range(_greatest_id(spec) + 1)]
        del spec
        letters = byte_letters()
        self.letters = {c: "".join(letters[b] for b in chr(c).encode()) for c in range(128, 256)}

    def _piece(self, piece: bytes) -> bytes:
        """The ids of a piece: of its words, or of itself if it is one word in lower case."""
        new = self.kept.new
        if piece[-1:] in _MARKS and piece[:-1].isalpha():
            return new[piece[:-1].lower()] + new[piece[-1:]]
        if piece.isalpha() and not piece.islower():
            return new[piece.lower()]
        text = piece.decode()
        if not _LETTERS.fullmatch(text):
            if "<|" in text or not _PLAIN.fullmatch(text):
                return self._ids([text])[0]
            words = _WORDS.findall(text.lower())
            if words != [text]:
                return b"".join([new[w.encode()] for w in words])
        # the model's splitting and folding leave such a word as it is
        found = self.model.tokenize(text if text.isascii() else text.translate(self.letters))
        if len(found) == 1:
            return self.id_bytes[found[0].id]
        return b"".join([self.id_bytes[t.id] for t in found])

    def _ids(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, self.dtype).tobytes() for x in found]

    def _joined(self, text: str) -> bytes:
        found = b"".join(map(self.kept.new.__getitem__, text.encode().split()))
        self.kept.tidy()
        return found

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.cuts:
            return self._ids(texts)
        return [
            self._joined(text) if len(text) <= BLOCK else b"".join(map(self._joined, _blocks(text))) for text in texts
        ]


def id_type(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return _id_type(json.load(f))


def _greatest_id(spec: dict) -> int:
    return max(*spec["model"]["vocab"].values(), *(t["id"] for t in spec["added_tokens"]))


def _id_type(spec: dict) -> str:
    return "<u2" if _greatest_id(spec) < 1 << 16 else "<u4"


def _forgets_space(spec: dict) -> bool:
    """The file composes, folds white space and case, and splits words off, dropping the rest."""
    steps = (spec["normalizer"] or {}).get("normalizers", [])
    kinds = [s["type"] for s in steps]
    parts = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
    plain_marks = all(
        t["content"].startswith("<|") and not (t["lstrip"] or t["rstrip"] or t["single_word"]) for t in spec["added_tokens"]
    )
    return (
        kinds == ["NFC", "Replace", "Lowercase"]
        and steps[1]["pattern"] == {"Regex": r"\s+"}
        and steps[1]["content"] == " "
        and [p["type"] for p in parts] == ["Split", "ByteLevel"]
        and (parts[0]["behavior"], parts[0]["invert"]) == ("Removed", True)
        and parts[0]["pattern"].get("Regex", "").endswith(SPLIT)
        and not parts[1]["add_prefix_space"]
        and plain_marks
        and spec["post_processor"] is None
        and spec["model"]["type"] == "BPE"
    )


def load(path: str) -> PieceEncoder:
    """One instance for each worker process and file; Spark's tasks are the only threads."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return kept_object(path, lambda: PieceEncoder(path))
