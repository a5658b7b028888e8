"""Token ids of whole texts from a tokenizer file, as little-endian unsigned 32-bit integers."""

from __future__ import annotations

import json
import os
import re
import struct
import unicodedata

import numpy as np

#: White space of this length overflows the stack of `tiktoken`; `tokenizers` takes it.
LONG_RUN = re.compile(r"\s{10000}")

#: Words whose ids a worker remembers, before it starts anew. Bounds memory, not results.
REMEMBERED = 700_000


def _alphabet() -> dict[str, int]:
    """Byte-level BPE files write byte b as a printable character; this is the way back."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Encoder:
    """Ids of the `tokenizers` file at `path`, without special tokens being added.

    Most files of byte-level BPE number their tokens in the order of the merges;
    then the same ids come faster from `tiktoken` over the file's own vocabulary,
    word by word from memory. A single space between two non-space characters is
    always a border between pre-tokens, so a text may be cut there. Files of any
    other kind, and texts that spell out a special token, go through `tokenizers`.
    """

    def __init__(self, path: str, pattern: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        self.words: dict[str, bytes] = {}
        self.fast = None
        ranks = self._ranks(spec)
        if ranks is not None:
            import tiktoken

            self.fast = tiktoken.Encoding(
                "file", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
            )

    def _ranks(self, spec: dict) -> dict[bytes, int] | None:
        model, pre = spec["model"], spec.get("pre_tokenizer") or {}
        plain = (
            model.get("type") == "BPE"
            and spec.get("normalizer") is None
            and pre.get("type") == "ByteLevel"
            and pre.get("use_regex", True)
            and not pre.get("add_prefix_space", True)
            and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback"))
        )
        if not plain:
            return None
        back, vocab, low = _alphabet(), model["vocab"], 256
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        if any(vocab.get("".join(m)) != low + k for k, m in enumerate(merges)):
            return None
        special = set(self.special)
        return {bytes(back[c] for c in t): i for t, i in vocab.items() if t not in special}

    def _whole(self, text: str) -> bytes:
        if self.fast is None or any(s in text for s in self.special) or LONG_RUN.search(text):
            ids = self.slow.encode(text, add_special_tokens=False).ids
        else:
            ids = self.fast.encode_ordinary(text)
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> bytes:
        if self.fast is None or any(s in text for s in self.special):
            return self._whole(text)
        head, *rest = text.split(" ")
        if not rest or not head or head[-1].isspace():
            return self._whole(text)
        words = self.words
        try:
            return self._whole(head) + b"".join(map(words.__getitem__, rest))
        except KeyError:
            pass
        if len(words) > REMEMBERED:
            words.clear()
        for w in rest:
            if w not in words:
                if not w or w[0].isspace() or w[-1].isspace():
                    return self._whole(text)
                words[w] = self._whole(" " + w)
        return self._whole(head) + b"".join(map(words.__getitem__, rest))


class WordEncoder:
    """Ids of a `tokenizers` file whose words carry an end mark, white space being dropped.

    No normal form, lower-casing or word of such a file reaches across a space or a
    newline, so each text is cut there and every chunk encoded once per worker. Chunks of
    Latin letters, digits and signs go through `tiktoken`, with a space in place of the
    end mark, which no word can hold; all others, and files of another kind, go through
    `tokenizers`, as do texts that spell out a special token.
    """

    LONGEST = 5000
    PLAIN = re.compile("[!-~\xa1-\u024f]+")
    #: The one pattern of words that is known here, and its classes among plain characters.
    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(path)
        self.special = [t.content for t in self.slow.get_added_tokens_decoder().values()]
        self.chunks: dict[str, bytes] = {"": b""}
        self.fast = self.words = None
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        if self._known(spec):
            import tiktoken

            back = _alphabet()
            mark = spec["model"]["end_of_word_suffix"]
            ranks = {}
            for token, i in spec["model"]["vocab"].items():
                if token not in self.special:
                    word = token.removesuffix(mark) if len(token) > len(mark) else token
                    ranks[bytes(back[c] for c in word) + b" " * (word != token)] = i
            words = self.PATTERN
            for kind in "LN":
                found = [chr(c) for c in range(0x250) if unicodedata.category(chr(c))[0] == kind]
                words = words.replace("\\p{%s}" % kind, "".join(found))
            self.words = re.compile(words)
            self.fast = tiktoken.Encoding(
                "words", pat_str="[^ ]+ ", mergeable_ranks=ranks, special_tokens={}
            )
            (self.mark,) = self.fast.encode_ordinary("\0 ")

    def _known(self, spec: dict) -> bool:
        """Whether white space is dropped, and the ids follow the order of the merges."""
        model, pre = spec["model"], spec.get("pre_tokenizer") or {}
        steps = [n.get("type") for n in (spec.get("normalizer") or {}).get("normalizers", [])]
        parts = pre.get("pretokenizers") or [{}]
        if (
            model.get("type") != "BPE"
            or not model.get("end_of_word_suffix")
            or any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "byte_fallback"))
            or steps != ["NFC", "Replace", "Lowercase"]
            or [p.get("type") for p in parts] != ["Split", "ByteLevel"]
            or parts[0].get("pattern") != {"Regex": self.PATTERN}
            or parts[0].get("behavior") != "Removed"
            or not parts[0].get("invert")
            or parts[1].get("use_regex", True)
            or parts[1].get("add_prefix_space", True)
        ):
            return False
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        return all(model["vocab"].get("".join(m)) == 512 + k for k, m in enumerate(merges))

    def _learn(self, new: list[str]) -> None:
        """Encode chunks in one call; the mark between them is a word that none of them holds."""
        plain = new if self.PLAIN.fullmatch("".join(new)) else [*filter(self.PLAIN.fullmatch, new)]
        plain = [c for c in plain if len(c) <= self.LONGEST]
        joined = unicodedata.normalize("NFC", " \0 ".join([*plain, ""])).lower()
        ids = np.array(self.fast.encode_ordinary(" ".join(self.words.findall(joined)) + " "), "<u4")
        cuts = np.flatnonzero(ids == self.mark).tolist()
        body = ids.tobytes()
        for c, start, stop in zip(plain, [-1, *cuts], cuts):
            self.chunks[c] = body[4 * start + 4 : 4 * stop]
        if len(plain) < len(new):
            for c in new:
                if c not in self.chunks:
                    ids = self.slow.encode(c, add_special_tokens=False).ids
                    self.chunks[c] = struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> bytes:
        if self.fast is None or any(s in text for s in self.special):
            ids = self.slow.encode(text, add_special_tokens=False).ids
            return struct.pack(f"<{len(ids)}I", *ids)
        parts, chunks = text.replace("\n", " ").split(" "), self.chunks
        try:
            return b"".join(map(chunks.__getitem__, parts))
        except KeyError:
            pass
        if len(chunks) > REMEMBERED:
            chunks.clear()
            chunks[""] = b""
        self._learn(list({c for c in parts if c not in chunks}))
        return b"".join(map(chunks.__getitem__, parts))


_encoders: dict[tuple, Encoder | WordEncoder] = {}


def encoder(path: str, pattern: str | None) -> Encoder | WordEncoder:
    """One encoder per worker process, so that its memory serves all its tasks.

    Without a `pattern` the file is one of whole words with end marks.
    """
    if (path, pattern) not in _encoders:
        _encoders[path, pattern] = WordEncoder(path) if pattern is None else Encoder(path, pattern)
    return _encoders[path, pattern]
