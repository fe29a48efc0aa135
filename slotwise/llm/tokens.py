"""Token ids of texts by a public tokenizer file of the tokenizers library.

The library spends most of its time on normalising and on alignments that ids
do not need. For a file whose tokens end words (``end_of_word_suffix``), texts
of plain letters, digits and punctuation are therefore encoded by a byte-pair
encoder compiled from the same file's vocabulary and merges: every word is
lower-cased and closed by one space, which stands for the suffix. All other
texts go to the tokenizers library itself, as does the first text of every
call: should the two ever disagree, the worker uses the library alone from
then on and encodes the whole call anew.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterable

# The split pattern and normalizers the fast path stands for.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NORMALIZERS = ["NFC", "Replace", "Lowercase"]

#: Characters whose lower case, composition and class need no tables.
UNPLAIN = re.compile("[^\n -~À-ÖØ-öø-įıĲ-ſ]|<\\|")
#: The compiled encoder's time grows with the square of a word's length.
LONG_WORD = 1000
#: What the pattern splits off besides runs of letters: a contraction, a digit
#: or a run of signs. It begins with one class, which the search skips to fast.
SPLIT_OFF = re.compile(r"[!-@\[-`{-~](?:(?<=')(?:s|t|re|ve|m|ll|d)|(?<![0-9])[^\sa-z0-9À-ÖØ-öø-ſ]+)?")


def _bytes_of_symbols() -> dict[str, int]:
    """Byte-level alphabets show printable bytes as themselves, others from U+0100 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def _compiled(spec: dict):
    """(tiktoken encoding, ids by rank) of a word-ending byte-level BPE, or None."""
    model, pre = spec["model"], spec.get("pre_tokenizer") or {}
    steps = [s.get("type") for s in (spec.get("normalizer") or {}).get("normalizers", [])]
    split = (pre.get("pretokenizers") or [pre])[0]
    same = (split.get("pattern") or {}).get("Regex") == WORD_PATTERN and split.get("behavior") == "Removed" and split.get("invert")
    end = model.get("end_of_word_suffix")
    if not (same and end and steps == NORMALIZERS and spec.get("post_processor") is None):
        return None
    import numpy as np
    import tiktoken

    symbols, vocab = _bytes_of_symbols(), model["vocab"]

    def raw(token: str) -> bytes:
        closed = token.endswith(end)
        return bytes(symbols[c] for c in (token[: -len(end)] if closed else token)) + (b" " if closed else b"")

    single = [c for c in symbols] + [c + end for c in symbols]
    merged = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
    order = [t for t in dict.fromkeys(single + merged) if t in vocab]
    # All single symbols come first, so a closing space is merged before any pair.
    ranks = {raw(t): i for i, t in enumerate(order)}
    if len(ranks) != len(order):  # a token that holds a space byte
        order = [t for t in order if t != next(s for s, b in symbols.items() if b == 32)]
        ranks = {raw(t): i for i, t in enumerate(order)}
    ranks.setdefault(b" ", len(ranks))
    encoding = tiktoken.Encoding("words", pat_str="[^ ]+ ", mergeable_ranks=ranks, special_tokens={})
    return encoding, np.array([vocab[t] for t in order] + [0], dtype="<u4")


class Encoder:
    """Ids of texts as arrays of little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path) as f:
            self.fast = _compiled(json.load(f))

    def by_library(self, texts: list[str]) -> list:
        import numpy as np

        return [np.array(e.ids, dtype="<u4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _plain(self, text: str):
        encoding, ids = self.fast
        words = SPLIT_OFF.sub(r" \g<0> ", text.lower().replace("\n", " ")) + " "
        return ids[encoding.encode_to_numpy(words, disallowed_special=())]

    def encode(self, texts: Iterable[str | None]) -> list:
        """Ids of every text; null counts as empty."""
        texts = [t or "" for t in texts]
        if self.fast is None:
            return self.by_library(texts)
        plain = [UNPLAIN.search(t) is None and max(map(len, t.split()), default=0) <= LONG_WORD for t in texts]
        other = iter(self.by_library([t for t, p in zip(texts, plain, strict=True) if not p]))
        out = [self._plain(t) if p else next(other) for t, p in zip(texts, plain, strict=True)]
        probe = next((i for i, p in enumerate(plain) if p and texts[i]), None)
        if probe is not None and self.by_library([texts[probe]])[0].tolist() != out[probe].tolist():
            self.fast = None
            return self.by_library(texts)
        return out


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a tokenizer file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
