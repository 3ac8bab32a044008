"""Token ids of whole texts with a public tokenizer file, a piece at a time.

The tokenizer drops white space and makes its ids within pieces: runs of letters, single digits, runs of signs. So the ids of a text are those
of its pieces, joined. Each worker keeps the ids of the pieces that it has met (up to ``CACHE`` of them, then it starts anew); only new ones go
to the library. Texts with characters that lower-casing or Unicode normalisation treat otherwise go to the library whole.
"""

from __future__ import annotations

import functools
import json
import os
import re
import unicodedata
from itertools import chain, repeat

import numpy as np

#: Pieces whose ids a worker keeps.
CACHE = 500_000
#: New pieces in one call of the library.
CALL = 4_000

#: Small Latin letters beyond ASCII; capitals whose small form is elsewhere (as that of U+0181) do not count.
_SMALL = "".join(c for c in map(chr, range(0xC0, 0x250)) if c.isalpha() and c.lower() == c and unicodedata.normalize("NFC", c) == c)
_LARGE = "".join(c for c in map(chr, range(0xC0, 0x250)) if c.isalpha() and c.lower() != c and c.lower() in _SMALL)
#: Letters, digits, punctuation and plain white space for which lower-casing and normalisation are local.
PLAIN = re.compile(rf"[\t\n\r -~{_SMALL}{_LARGE}]*").fullmatch
PIECE = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[a-z{_SMALL}]+|[0-9]|[^\sa-z0-9{_SMALL}]+")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # For single pieces, already normalised and set apart by spaces, only the byte mapping and the model are left to do.
        parts = json.loads(self.tokenizer.to_str())
        own = parts["pre_tokenizer"]["pretokenizers"]
        parts |= {"normalizer": None, "added_tokens": [], "pre_tokenizer": {"type": "Sequence", "pretokenizers": [{"type": "WhitespaceSplit"}, own[-1]]}}
        self.model = Tokenizer.from_str(json.dumps(parts))
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        size = self.tokenizer.get_vocab_size()
        self.ends = np.array([(self.tokenizer.id_to_token(i) or "").endswith("</w>") for i in range(size)])
        self.forget()

    def forget(self) -> None:
        """Empties the store: numbers of pieces, and where in ``pool`` the ids of each begin."""
        self.number: dict[str, int] = {}
        self.pool, self.filled = np.zeros(1 << 16, dtype="<u4"), 0
        self.start = np.zeros(CACHE + 1, dtype=np.int64)

    def library(self, text: str, whole: bool = True) -> np.ndarray:
        tokenizer = self.tokenizer if whole else self.model
        return np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")

    def add(self, ids: np.ndarray, stops: np.ndarray, pieces: list[str]) -> None:
        while self.filled + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        self.pool[self.filled : self.filled + len(ids)] = ids
        first = len(self.number)
        self.start[first + 1 : first + 1 + len(pieces)] = self.filled + stops
        self.number.update(zip(pieces, range(first, first + len(pieces))))
        self.filled += len(ids)

    def gather(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of known pieces one after the other, and where each one's end."""
        begin, size = self.start[at], self.start[at + 1] - self.start[at]
        stop = np.cumsum(size)
        return self.pool[np.repeat(begin - stop + size, size) + np.arange(stop[-1] if len(stop) else 0)], stop

    def learn(self, pieces: list[str]) -> None:
        """Ids of new pieces: many in one call of the library, where each ends at a token that ends a word."""
        for at in range(0, len(pieces), CALL):
            some = pieces[at : at + CALL]
            ids = self.library(" ".join(some), whole=False)
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) != len(some):  # a piece was split otherwise: one by one
                each = list(map(self.library, some))
                ids, stops = np.concatenate(each), np.cumsum(list(map(len, each)))
            self.add(ids, stops, some)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian 32-bit ids of each text; a null text has none."""
        whole = [not PLAIN(t) or ("<|" in t and any(s in t for s in self.specials)) for t in (t or "" for t in texts)]
        split = [[] if w else PIECE.findall((t or "").lower()) for t, w in zip(texts, whole)]
        flat = list(chain.from_iterable(split))
        at = np.fromiter(map(self.number.get, flat, repeat(-1)), dtype=np.int64, count=len(flat))
        unknown = np.flatnonzero(at < 0).tolist()
        new = list({flat[i] for i in unknown})
        if len(self.number) + len(new) > CACHE:
            self.forget()
            new, unknown = list(set(flat)), list(range(len(flat)))
            if len(new) > CACHE:  # more than is ever kept: in halves
                half = len(texts) // 2
                return self.encode(texts[:half]) + self.encode(texts[half:]) if half else [self.library(texts[0] or "").tobytes()]
        if new:
            self.learn(new)
            at[unknown] = [self.number[flat[i]] for i in unknown]
        ids, stop = self.gather(at)
        ids = ids.tobytes()
        bounds = (4 * np.concatenate([[0], stop])[np.cumsum([0, *map(len, split)])]).tolist()
        return [self.library(t).tobytes() if w else ids[a:b] for t, w, a, b in zip(texts, whole, bounds, bounds[1:])]


@functools.cache
def encoder(path: str) -> Encoder:
    return Encoder(path)
