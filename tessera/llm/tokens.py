"""A word-end BPE tokenizer that keeps the ids of what stands between white space."""

from __future__ import annotations

import json
import re

import numpy as np

#: A path, or public:NAME for a vocabulary of the installed public_tokenizers.
TOKENIZER = "public:word_bpe_49k.json"
#: Entries kept by one worker, some 200 MB.
KEPT = 900_000
#: In texts of other characters, lower case, white space and composition may not be those of the tokenizer's own steps.
PLAIN = re.compile(r"[\t\n\r\x20-\x7e¡-¬®-įĲ-ŷ‐-‧€]*")

#: Parts given to the tokenizer at once; its results take far more memory than the ids.
SLICE = 10_000
#: Stands between parts; plain texts do not have it, and the tokenizer makes it one token.
MARK = "\x01"

_loaded: dict[str, tuple] = {}


class CachedTokenizer:
    """encode(text): the ids that the tokenizer gives without special tokens, as little-endian unsigned 32-bit numbers.

    The tokenizer's pattern never crosses white space, and it lowers letters before it, so ids of a plain text are those of
    its lowered parts, joined. A text that isn't plain, or may hold a special token, is given to the tokenizer as it is.
    """

    def __init__(self, name: str = TOKENIZER, kept: int = KEPT) -> None:
        self.kept = kept
        if name not in _loaded:
            from tokenizers import Tokenizer

            path = name
            if name.startswith("public:"):
                import public_tokenizers

                path = public_tokenizers.path(name.removeprefix("public:"))
            whole = Tokenizer.from_file(path)
            rules = json.loads(whole.to_str())
            rules["normalizer"] = None  # parts are composed, lower and without white space already
            _loaded[name] = (whole, Tokenizer.from_str(json.dumps(rules)), {})
        self.tokenizer, self.plain, self.known = _loaded[name]
        (self.mark,) = self.tokenizer.encode(MARK, add_special_tokens=False).ids

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def learn(self, parts: list[str]) -> None:
        for at in range(0, len(parts), SLICE):
            some = parts[at : at + SLICE]
            lines = [f" {MARK} ".join(some[i : i + 500]) + f" {MARK}" for i in range(0, len(some), 500)]
            ids = np.concatenate([np.array(got.ids, "<u4") for got in self.plain.encode_batch_fast(lines, add_special_tokens=False)])
            ends = np.flatnonzero(ids == self.mark)
            if len(ends) != len(some):
                raise ValueError("the mark between parts is not a token of its own")
            data, first = ids.tobytes(), 0
            for p, end in zip(some, (ends * 4).tolist(), strict=True):
                self.known[p] = data[first:end]
                first = end + 4

    def encode_all(self, texts: list[str]) -> list[bytes]:
        if len(self.known) > self.kept:
            self.known.clear()
        get, out, open_, new = self.known.get, [], [], {}
        for text in texts:
            if "<|" in text or not PLAIN.fullmatch(text):
                out.append(self.whole(text))
                continue
            parts = text.lower().split()
            got = list(map(get, parts))
            if None in got:
                gaps = [i for i, ids in enumerate(got) if ids is None]
                missing = [parts[i] for i in gaps]
                new.update(dict.fromkeys(missing))
                open_.append((len(out), got, gaps, missing))
                out.append(b"")
            else:
                out.append(b"".join(got))
        self.learn(list(new))
        for at, got, gaps, missing in open_:
            for i, p in zip(gaps, missing, strict=True):
                got[i] = self.known[p]
            out[at] = b"".join(got)
        return out

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]
