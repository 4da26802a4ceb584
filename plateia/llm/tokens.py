"""Exact token ids of whole texts, with repeated words encoded once per worker."""

from __future__ import annotations

import json
from array import array

import regex
from tokenizers import Tokenizer

NO_IDS = b""

# Chunks of these characters are NFC already, and lower case maps each on its own.
_PLAIN = regex.compile("[!-~¡-ĩı-ɏ]+")

# ASCII characters that are neither letters, digits nor blanks: a run of them is one piece.
_MARKS = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum())


def _byte_letters() -> dict[int, str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {byte: chr(byte) for byte in kept}
    for byte in range(256):
        if byte not in letters:
            letters[byte] = chr(256 + len(letters) - len(kept))
    return letters


class Encoder:
    """Encodes texts with a tokenizer file, as ``encode(text, add_special_tokens=False)`` does.

    A tokenizer that drops white space treats the chunks between blanks
    independently: the ids of a text are those of its chunks in order. ASCII texts
    are lowered whole first. Chunks are kept in two dictionaries, a current and an older
    one: when the current one is full, by entries or bytes, it becomes the older,
    and chunks met again move on. Tokenizers of another kind encode every text whole.
    """

    def __init__(self, path: str, kept_chunks: int = 1 << 17, kept_bytes: int = 1 << 23):
        self.tokenizer = Tokenizer.from_file(path)
        self.kept_chunks, self.kept_bytes = kept_chunks, kept_bytes
        with open(path, encoding="utf-8") as file:
            settings = json.load(file)
        self.pattern = _chunk_pattern(settings)
        self.forget()
        if self.pattern is None:
            return
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        special = [token["content"] for token in settings["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, special)) or "(?!)")

    def forget(self) -> None:
        """Let go of all chunks; a task does so when it ends, as its worker lives on."""
        self.chunks: dict[str, bytes] = {"": NO_IDS}
        self.older: dict[str, bytes] = {}
        self.bytes = 0

    def encode(self, text: str) -> bytes:
        """Ids as unsigned little-endian 32-bit integers."""
        if self.pattern is None:
            return self._whole(text)
        if text.isascii():
            low = text.lower()
            # What only lower case makes a special token is none.
            text = text if self.special.search(low) else low
        chunks = text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
        new = set(chunks).difference(self.chunks)
        if new and (len(self.chunks) > self.kept_chunks or self.bytes > self.kept_bytes):
            self.older, self.chunks, self.bytes = self.chunks, {"": NO_IDS}, 0
            new = set(chunks).difference(self.chunks)
        for chunk in new:
            known = self.older.get(chunk)
            ids = self.chunks[chunk] = self._chunk(chunk) if known is None else known
            self.bytes += len(chunk) + len(ids)
        return b"".join(map(self.chunks.__getitem__, chunks))

    def _whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _chunk(self, chunk: str) -> bytes:
        if chunk.isascii() or _PLAIN.fullmatch(chunk):
            # A word, perhaps with marks behind it: most chunks of running text.
            low = chunk.lower()
            if low.isalpha():
                return self._piece(low)
            word = low.rstrip(_MARKS)
            if word.isalpha():
                return self._known(word) + self._known(low[len(word) :])
        if not _PLAIN.fullmatch(chunk) or self.special.search(chunk):
            return self._whole(chunk)
        return b"".join(map(self._piece, self.pattern.findall(chunk.lower())))

    def _known(self, piece: str) -> bytes:
        """The ids of a piece, looked up where it stood as a chunk."""
        ids = self.chunks.get(piece)
        if ids is None:
            ids = self.older.get(piece)
        return self._piece(piece) if ids is None else ids

    def _piece(self, piece: str) -> bytes:
        if not piece.isascii():
            piece = piece.encode().decode("latin-1").translate(self.letters)
        return array("I", [token.id for token in self.model.tokenize(piece)]).tobytes()


def _chunk_pattern(settings: dict) -> regex.Pattern | None:
    """The word pattern, if the tokenizer lower-cases, drops white space and maps bytes."""
    normalizer, splitter = settings.get("normalizer") or {}, settings.get("pre_tokenizer") or {}
    steps = [step["type"] for step in normalizer.get("normalizers", [])]
    parts = splitter.get("pretokenizers", [])
    if steps != ["NFC", "Replace", "Lowercase"] or [p["type"] for p in parts] != ["Split", "ByteLevel"]:
        return None
    split, mapped = parts
    if split["behavior"] != "Removed" or not split["invert"] or mapped["add_prefix_space"] or mapped["use_regex"]:
        return None
    return regex.compile(split["pattern"]["Regex"])


_encoders: dict[tuple[str, int], Encoder] = {}


def encoder(path: str, kept_chunks: int = 1 << 17) -> Encoder:
    """One encoder per file, size and worker process."""
    key = path, kept_chunks
    if key not in _encoders:
        _encoders[key] = Encoder(path, kept_chunks, kept_chunks << 6)
    return _encoders[key]
