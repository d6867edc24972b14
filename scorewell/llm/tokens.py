"""Tokenising whole texts with the ``tokenizers`` library, a chunk at a time.

Two kinds of public vocabulary cut a text at places that depend on white
space alone, so the ids of a text are the ids of its chunks put together:

* ``drop``: the normaliser squeezes white space and the pre-tokeniser
  throws it away (word BPE).  A chunk is a run without ASCII white space.
* ``lead``: the byte-level pattern lets white space lead the next piece and
  never follow one.  A chunk is white space and the run after it.

Chunks repeat far more than texts do, so each worker keeps the ids of the
chunks it has met and asks the library only about new ones.  Any other
vocabulary is handed whole texts (``whole``).  Tests compare the ids with
those that the library gives for whole texts.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from functools import lru_cache

#: Unicode white space, as the library's patterns know it.
_WS = "\t-\r \x85\xa0  -     　"
_LATIN = "A-Za-zÀ-ÖØ-öø-ÿ"
#: A word before a stop is a chunk of its own, as no piece reaches over there.
_LEAD = re.compile(f"[{_WS}]*[{_LATIN}]++(?=[.,;:!?])|[{_WS}]*[^{_WS}]+|[{_WS}]+")


def chunking(spec: dict) -> str:
    """How texts may be cut for this vocabulary: ``drop``, ``lead`` or ``whole``."""
    special = [t["content"] for t in spec.get("added_tokens") or []]
    if any(re.search(f"[{_WS}]", s) for s in special) or any(
            t.get("lstrip") or t.get("rstrip") or t.get("single_word")
            for t in spec.get("added_tokens") or []):
        return "whole"
    pre, norm = spec.get("pre_tokenizer") or {}, spec.get("normalizer") or {}
    if pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get(
            "add_prefix_space") and not norm and not spec.get("post_processor"):
        return "lead"
    splits = pre.get("pretokenizers") or [{}]
    squeezed = any(n.get("type") == "Replace" and n.get("pattern") == {"Regex": "\\s+"}
                   for n in norm.get("normalizers") or [])
    if squeezed and splits[0].get("type") == "Split" and splits[0].get(
            "behavior") == "Removed" and splits[0].get("invert") and not spec.get(
            "post_processor"):
        return "drop"
    return "whole"


_LETTERS = {"lead": re.compile(f" ?[{_LATIN}]+"),
            "drop": re.compile("[a-zß-öø-ÿ]+")}


def _byte_letters() -> dict[int, str]:
    """The library's printable stand-in for each byte of a two-byte character or less."""
    from tokenizers.pre_tokenizers import ByteLevel

    level = ByteLevel(add_prefix_space=False, use_regex=False)
    out: dict[int, str] = {}
    for c in map(chr, range(0x20, 0x800)):
        out.update(zip(c.encode(), level.pre_tokenize_str(c)[0][0]))
    return out


class _Known(dict):
    """Chunk -> ids as bytes; asks the library about a chunk not met before.

    A chunk of Latin letters is one piece as it stands, so the library's
    model is asked directly.  A piece never reaches from a letter over to a
    stop, so a chunk's final stops are looked up apart from the rest.
    """

    def __init__(self, tok, mode: str):
        super().__init__()
        self.encode, self.tokenize = tok.encode, tok.model.tokenize
        self.as_bytes = mode == "drop"
        self.letters, self.stand_in = _LETTERS[mode], _byte_letters()
        self.stops = b".,;:!?" if self.as_bytes else ".,;:!?"

    def __missing__(self, chunk):
        core = chunk.rstrip(self.stops)
        last = core[-1:]
        if len(core) < len(chunk) and last.isalpha() and last.isascii():
            ids = self[core] + self[chunk[len(core):]]
        else:
            text = chunk.decode() if self.as_bytes else chunk
            if self.letters.fullmatch(text):
                piece = text.encode().decode("latin-1").translate(self.stand_in)
                found = [t.id for t in self.tokenize(piece)]
            else:
                found = self.encode(text, add_special_tokens=False).ids
            ids = array("I", found).tobytes()
        self[chunk] = ids
        return ids


class TextEncoder:
    """Texts to ids as little-endian unsigned 32-bit bytes."""

    def __init__(self, spec: str, keep: int = 1_500_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        rules = json.loads(spec)
        self.tok = Tokenizer.from_str(spec)
        self.mode = chunking(rules)
        self.special = [t["content"].encode().lower() for t in rules.get("added_tokens") or []]
        self.keep = keep
        self.known = _Known(self.tok, self.mode) if self.mode != "whole" else {}

    def _cut(self, text: str) -> list:
        if self.mode == "lead":
            return _LEAD.findall(text)
        raw = text.encode()
        low = raw.lower()  # A-Z; the vocabulary's own normaliser lower-cases everything
        return (raw if any(s in low for s in self.special) else low).split()

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text; null is an empty text."""
        if self.mode == "whole":
            return [array("I", e.ids).tobytes() for e in self.tok.encode_batch(
                [t or "" for t in texts], add_special_tokens=False)]
        if len(self.known) > self.keep:
            self.known.clear()
        ids = self.known.__getitem__
        return [b"".join(map(ids, self._cut(t))) if t else b"" for t in texts]


@lru_cache(maxsize=2)
def text_encoder(spec: str) -> TextEncoder:
    """The worker's encoder, which later tasks of the worker find warm."""
    return TextEncoder(spec)


def load_spec(path: str) -> str:
    """The vocabulary file's text, read on the driver (a few MB) and sent to
    the tasks, so executors need no copy of the file."""
    with open(path, encoding="utf-8") as f:
        return f.read()
