"""Token ids of whole texts by a public byte-level BPE tokenizer file.

The ids are those of the tokenizers library for the file. Where the file is
plain byte-level BPE whose merges are in the order of their ids, tiktoken makes
the same ids from the same vocabulary in a fraction of the time (tests compare
the two over all characters); other files, and texts that hold the string of a
special token, go to the tokenizers library itself.
"""
from __future__ import annotations

import json
import os
import re
from functools import lru_cache

import numpy as np

BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}


def byte_characters() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def ranks_of(config: dict) -> dict[bytes, int] | None:
    """Bytes and id of each token, if ids alone give the order of merges; else None."""
    model, before = config["model"], config.get("pre_tokenizer") or {}
    options = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
    if (model.get("type") != "BPE" or config.get("normalizer") or any(model.get(k) for k in options)
            or any(before.get(k) != v for k, v in BYTE_LEVEL.items())):
        return None
    vocab = model["vocab"]
    special = {t["content"] for t in config.get("added_tokens", [])}
    made = [vocab.get("".join(m) if isinstance(m, list) else m.replace(" ", "")) for m in model["merges"]]
    if None in made or any(a >= b for a, b in zip(made, made[1:])):
        return None
    to_byte = byte_characters()
    return {bytes(to_byte[c] for c in token): i for token, i in vocab.items() if token not in special}


class ByteBpe:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            config = json.load(file)
        special = [t["content"] for t in config.get("added_tokens", [])]
        self.special = re.compile("|".join(map(re.escape, special)) or r"(?!)")
        ranks = ranks_of(config)
        self.fast = None
        if ranks:
            import public_tokenizers
            import tiktoken

            self.fast = tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str | None) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers; none for null."""
        if not text:
            return b""
        if self.fast is not None and not self.special.search(text):
            return self.fast.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False).tobytes()
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


@lru_cache(maxsize=2)
def load_tokenizer(path: str) -> ByteBpe:
    return ByteBpe(path)
