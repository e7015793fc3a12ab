"""Ids of a lower-casing BPE file with word ends, as the tokenizers library gives them.

White space is dropped by such a file, so runs between ASCII blanks are encoded each
for itself and remembered. Runs of letters whose lower case and composition are plain
(ASCII and Latin letters up to U+024F) use the merge table; all others, and special
tokens in a text, go through the library.
"""

from __future__ import annotations

import functools
import json
import os
import re

import numpy as np
import regex

from vicinity.llm.bpe import MergeTable
from vicinity.llm.encoding import Memo, split_dropped

# Fixed value: the pre-token pattern of the file; a blank stands between runs here.
WORD_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+| "
PLAIN = re.compile(r"[!-~À-ÖØ-öø-įı-ɏ]+").fullmatch


class WordEncoder(Memo):
    def __init__(self, path: str) -> None:
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.table = MergeTable(spec, self.special)
        self.pre_tokens = regex.compile(WORD_TOKEN).findall
        self.split = split_dropped

    def encode_new(self, parts):
        plain, other = [], []
        for part in parts:
            known = PLAIN(part) and not any(s in part for s in self.special)
            (plain if known else other).append(part)
        for start in range(0, len(plain), 1 << 15):
            yield from self._encode(plain[start : start + (1 << 15)])
        for start in range(0, len(other), 4096):
            some = other[start : start + 4096]
            for part, found in zip(some, self.library.encode_batch_fast(some, add_special_tokens=False), strict=True):
                yield part, np.array(found.ids, "<u4").tobytes()

    def _encode(self, parts: list[str]):
        joined = " ".join(map(str.lower, parts)) + " "
        tokens = self.pre_tokens(joined)
        data = np.frombuffer(joined.encode(), np.uint8)
        places = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
        token_ends = places[np.cumsum(np.fromiter(map(len, tokens), np.int64))]
        first = self.table.byte_ids[data]
        first[token_ends - 1] = self.table.last_ids[data[token_ends - 1]]
        first[data == 0x20] = -1  # joins nothing and marks the ends of parts
        ids, _ = self.table.merge(first, self.table.cut(data, token_ends))
        gaps = np.flatnonzero(ids < 0)
        packed, at = ids[ids >= 0].astype("<u4").tobytes(), 0
        for part, to in zip(parts, (4 * (gaps - np.arange(len(gaps)))).tolist(), strict=True):
            yield part, packed[at:to]
            at = to


@functools.lru_cache(maxsize=2)
def word_encoder(path: str) -> WordEncoder:
    """One per worker process and file."""
    return WordEncoder(path)
